"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def catalog_view(spark: SparkSession, table: str, view: str) -> DataFrame:
    """Read a catalog table and expose it to SQL text under ``view``."""
    df = spark.table(table)
    df.createOrReplaceTempView(view)
    return df


def table_partitions(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """Partition values known to the catalog: no directory is listed at all."""
    shown = spark.sql("SHOW PARTITIONS IDENTIFIER(:table)", args={"table": table})
    value = F.regexp_extract("partition", rf"(?:^|/){partition}=([^/]+)", 1)
    return shown.select(value.try_cast("date").alias(partition)).distinct()
