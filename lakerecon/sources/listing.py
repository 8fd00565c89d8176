"""Directory listings as DataFrames: file paths, sizes and times only, never file contents."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType, TimestampType

from ..model import PARTITION_COLUMN
from .files import _no_data, calendar_date, calendar_glob, partition_glob

_FILES = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
    ]
)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every data file below ``root``; no rows when ``root`` does not exist."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    except AnalysisException as error:
        if _no_data(error):
            return spark.createDataFrame([], _FILES)
        raise
    return files.select("path", "modificationTime", "length")


def _summarise(files: DataFrame, partition: str) -> DataFrame:
    return (
        files.filter(F.col(partition).isNotNull())
        .groupBy(partition)
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("bytes"),
            F.max("length").alias("largest"),
            F.max("modificationTime").alias("last_modified"),
            F.max_by("path", F.struct("modificationTime", "path")).alias("newest"),
        )
    )


def list_partitions(
    spark: SparkSession, root: str, partition: str = PARTITION_COLUMN, values: Iterable[date | str] | None = None
) -> DataFrame:
    """One row per ``partition=value`` directory: files, bytes, largest file, latest change, newest file.

    ``values`` narrows the listing to those directories. Values that are not dates are left out, see
    ``list_undated``.
    """
    path = root if values is None else partition_glob(root, values, partition)
    value = F.regexp_extract("path", rf"/{partition}=([^/]+)/", 1)
    return _summarise(
        list_files(spark, path).withColumn(partition, F.nullif(value, F.lit("")).try_cast(DateType())), partition
    )


def list_undated(spark: SparkSession, root: str, partition: str = PARTITION_COLUMN) -> DataFrame:
    """The ``partition=value`` directories whose value is not a date, which listings by date leave out."""
    value = F.nullif(F.regexp_extract("path", rf"/{partition}=([^/]+)/", 1), F.lit(""))
    found = list_files(spark, root).withColumn("value", value).filter(F.col("value").isNotNull())
    undated = found.filter(F.col("value").try_cast(DateType()).isNull())
    return undated.groupBy("value").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def list_calendar(
    spark: SparkSession, root: str, partition: str = PARTITION_COLUMN, values: Iterable[date] | None = None
) -> DataFrame:
    """The same for ``yyyy/mm/dd`` directories."""
    path = root if values is None else calendar_glob(root, values)
    return _summarise(list_files(spark, path).withColumn(partition, calendar_date(F.col("path"))), partition)
