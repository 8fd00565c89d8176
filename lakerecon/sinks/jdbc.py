"""Relational sinks.

Each Spark partition is written in its own transaction. An executor lost after its commit but
before reporting is run again, so an append can repeat rows: load a table with a primary key, or a
staging table, and check with ``verify_load``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import has_rows
from ..sources.jdbc import read_jdbc


def write_options(
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    partitions: int | None = None,
    isolation: str = "READ_COMMITTED",
    untyped_strings: bool = False,
) -> dict[str, str]:
    """Writer properties; ``untyped_strings`` lets the database cast text to its column types."""
    options = {"batchsize": str(batch_size), "isolationLevel": isolation}
    if partitions is not None:
        options["numPartitions"] = str(partitions)
    if untyped_strings:
        options["stringtype"] = "unspecified"
    return {**options, **(properties or {})}


def load_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Append to a table; keyword arguments as for ``write_options``."""
    df.write.jdbc(url, table, mode="append", properties=write_options(**options))


def reload_jdbc(df: DataFrame, url: str, table: str, **options) -> bool:
    """Empty the table and load it again, keeping its definition, but only if there is new input.

    Truncation commits before the insert: readers may see an empty table in between.
    """
    if not has_rows(df):
        return False
    properties = {**write_options(**options), "truncate": "true"}
    df.write.jdbc(url, table, mode="overwrite", properties=properties)
    return True


def verify_load(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None) -> int:
    """Rows now in the table, counted by the database."""
    counted = read_jdbc(spark, url, f"select count(*) as row_count from {table}", properties)
    return int(counted.first()["row_count"])
