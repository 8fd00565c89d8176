"""What the operators share on the side of DataFrames."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerecon.session import shared_dir

#: Rows up to which a table of short rows is sent to every executor.
BROADCAST_ROWS = 500_000


def _findable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it, besides the places that are set up for them."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``run`` takes and gives iterators of Arrow record batches, one partition at a time."""
    _findable(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, key: str, run, schema) -> DataFrame:
    """``run`` takes and gives one Arrow table per group; only for groups of a bounded size."""
    _findable(df.sparkSession)
    return df.groupBy(key).applyInArrow(run, schema)


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and lost executors cost nothing."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it is counted to have at most ``rows`` rows; else a shuffled join is left to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % divisor, F.lit(0))
