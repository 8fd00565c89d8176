"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.stats import counted

# Text formats write milliseconds unless told otherwise, which would lose digits of the input.
MICROSECONDS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _text_options(fmt: str) -> Mapping[str, str]:
    return MICROSECONDS if fmt in ("json", "csv") else {}


def write_history(
    df: DataFrame, root: str, by: Sequence[str], fmt: str = "json", **options: str
) -> None:
    """Replace the partitions present in ``df`` in one job; other partitions are untouched.

    A repeated run gives the same directory.
    """
    settings = {**_text_options(fmt), **options, "partitionOverwriteMode": "dynamic"}
    df.write.mode("overwrite").options(**settings).partitionBy(*by).format(fmt).save(root)


def write_raw(
    df: DataFrame,
    root: str,
    by: Sequence[str],
    fixed_value: str | date | None = None,
    compression: str = "gzip",
    mode: str = "append",
    fmt: str = "json",
) -> None:
    """Land rows as partitioned, compressed files.

    ``fixed_value`` puts all rows under one value of the first partition column (the run date, or
    one value for an initial load); otherwise the frame carries the partition columns.
    """
    if fixed_value is not None:
        df = df.withColumn(by[0], F.lit(fixed_value))
    writer = df.write.mode(mode).options(**_text_options(fmt), compression=compression)
    (writer.partitionBy(*by) if by else writer).format(fmt).save(root)


def quarantine(df: DataFrame, path: str) -> None:
    """Append rejected rows."""
    df.write.mode("append").options(**MICROSECONDS).json(path)


def export_missing(df: DataFrame, path: str) -> int:
    """Write rows as CSV with a header and return how many there were.

    Without rows nothing is written; an export that an earlier run left there is then replaced by an empty one.
    """
    if df.isEmpty():
        try:
            df.sparkSession.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if (error.getCondition() or "").startswith("PATH_NOT_FOUND"):
                return 0
            raise
    kept, seen = counted(df)
    kept.write.mode("overwrite").options(**MICROSECONDS, header="true").csv(path)
    return seen.get["rows"]
