"""Incremental scans: only rows beyond the last committed key values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.schemas import typed_literal
from .files import _no_data


def read_increment(df: DataFrame, keys: Sequence[str], after: Row | dict | None) -> DataFrame:
    """Rows whose key tuple is greater than ``after``; all rows when there is no mark yet.

    The comparison is spelled out column by column because a struct comparison is not pushed down
    to Parquet or JDBC, while these plain comparisons are.
    """
    if after is None:
        return df
    mark = after.asDict() if isinstance(after, Row) else dict(after)
    values = {k: typed_literal(mark[k], df.schema[k].dataType) for k in keys}
    beyond = F.lit(False)
    for key in reversed(keys):
        beyond = (F.col(key) > values[key]) | ((F.col(key) == values[key]) & beyond)
    return df.filter((F.col(keys[0]) >= values[keys[0]]) & beyond)


def read_up_to(df: DataFrame, keys: Sequence[str], mark: Row | dict) -> DataFrame:
    """Rows whose key tuple is at most ``mark``, null keys included."""
    mark = mark.asDict() if isinstance(mark, Row) else dict(mark)
    values = {k: typed_literal(mark[k], df.schema[k].dataType) for k in keys}
    first = F.col(keys[0])
    top = F.struct(*[values[k].alias(k) for k in keys])
    return df.filter((first.isNull() | (first <= values[keys[0]])) & (F.struct(*keys) <= top))


def highest_key(keys: Sequence[str]):
    """Aggregate giving the greatest key tuple."""
    return F.max(F.struct(*keys))


class HighWater:
    """Committed key values per job, as append-only Parquet tables with typed key columns.

    A run first states what it is about to write (``begin``) and commits the mark after the sink has
    succeeded. A run that failed in between is repeated under the same batch number and value, so a
    sink that replaces the batch's own files holds every row once.
    """

    def __init__(self, spark: SparkSession, root: str, job: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/marks/job={job}"
        self.intents = f"{root.rstrip('/')}/intents/job={job}"

    def _newest(self, path: str) -> Row | None:
        try:
            return self.spark.read.parquet(path).orderBy(F.desc("version")).first()
        except AnalysisException as error:
            if _no_data(error):
                return None
            raise

    def load(self) -> Row | None:
        row = self._newest(self.path)
        return row["mark"] if row else None

    def next_version(self) -> int:
        row = self._newest(self.path)
        return row["version"] + 1 if row else 1

    def begin(self, value: str) -> tuple[int, str]:
        """Batch number and value to write under: those of the unfinished run if there is one."""
        version, last = self.next_version(), self._newest(self.intents)
        if last and last["version"] == version:
            return version, last["value"]
        row = self.spark.createDataFrame([(version, value)], "version bigint, value string")
        row.coalesce(1).write.mode("append").parquet(self.intents)
        return version, value

    def commit(self, mark: Row, schema: StructType) -> None:
        """Append a new mark; ``schema`` holds the key columns' types."""
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        names = [f.name for f in schema.fields]
        row = (self.next_version(), *[mark[n] for n in names])
        flat = self.spark.createDataFrame([row], f"version bigint, {fields}")
        flat.select("version", F.struct(*names).alias("mark")).coalesce(1).write.mode("append").parquet(self.path)
