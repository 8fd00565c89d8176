"""File scans. Partition values restrict which directories are listed, not only which rows are kept."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.schemas import as_struct
from ..model import PARTITION_COLUMN


# Formats whose files may differ in schema and can be read with the union of all.
MERGEABLE = ("parquet", "orc")


def read_events(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "json",
    schema: StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """Scan files. Without ``schema`` a JSON scan first reads everything once to infer one.

    For ``fmt="avro"`` a schema text is passed on as the reader schema; the Avro data source is a
    separate Spark module that has to be on the classpath.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        if fmt == "avro" and isinstance(schema, str):
            reader = reader.option("avroSchema", schema)
        else:
            reader = reader.schema(as_struct(schema))
    return reader.load([paths] if isinstance(paths, str) else list(paths))


def _no_data(error: AnalysisException) -> bool:
    """A directory that is absent, or there but without files."""
    return (error.getCondition() or "").startswith(("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def partition_glob(root: str, values: Iterable[date | str], partition: str = PARTITION_COLUMN) -> str:
    """A path pattern naming the given partitions; those that do not exist simply do not match."""
    return f"{root.rstrip('/')}/{partition}={{{','.join(str(v) for v in values)}}}"


def read_partitions(
    spark: SparkSession,
    root: str,
    values: Iterable[date | str],
    fmt: str = "json",
    schema: StructType | str | None = None,
    partition: str = PARTITION_COLUMN,
    **options: str,
) -> DataFrame | None:
    """Scan only the named partitions, keeping the partition column; None when none of them exists.

    Only the matching directories are listed, so the cost does not grow with the history.
    """
    values = sorted(str(v) for v in values)
    if not values:
        return None
    if schema is not None and fmt != "avro":
        schema = as_struct(schema)
        if partition not in schema.names:
            schema = StructType([*schema.fields, StructField(partition, DateType())])
    try:
        df = read_events(
            spark, partition_glob(root, values, partition), fmt, schema, basePath=root, **options
        )
    except AnalysisException as error:
        if _no_data(error):
            return None
        raise
    return df.filter(F.col(partition).isin([date.fromisoformat(v) for v in values]))


def partition_exists(
    spark: SparkSession, root: str, values: Iterable[date | str], partition: str = PARTITION_COLUMN
) -> bool:
    """True when at least one of the named partitions holds a file."""
    try:
        found = spark.read.format("binaryFile").load(partition_glob(root, values, partition))
    except AnalysisException as error:
        if _no_data(error):
            return False
        raise
    return has_rows(found.select("path"))


def has_rows(df: DataFrame) -> bool:
    """Gate for steps that must not run on empty input."""
    return not df.isEmpty()


def calendar_glob(root: str, days: Iterable[date]) -> str:
    """A path pattern naming the given ``yyyy/mm/dd`` directories."""
    return f"{root.rstrip('/')}/{{{','.join(d.strftime('%Y/%m/%d') for d in sorted(days))}}}"


def read_calendar(
    spark: SparkSession,
    root: str,
    days: Iterable[date] | None = None,
    fmt: str = "json",
    schema: StructType | str | None = None,
    partition: str = PARTITION_COLUMN,
) -> DataFrame:
    """Scan ``root/yyyy/mm/dd`` directories and derive the date column from each row's file path.

    ``days`` narrows the listing to those directories.
    """
    path = root if days is None else calendar_glob(root, days)
    df = read_events(spark, path, fmt, schema, recursiveFileLookup="true")
    return df.withColumn(partition, calendar_date(F.col("_metadata.file_path")))


def calendar_date(path):
    """The last date in a ``…/yyyy/mm/dd/…/file`` path; null when there is none."""
    return F.try_to_date(F.nullif(F.regexp_extract(path, r".*/(\d{4}/\d{2}/\d{2})/", 1), F.lit("")), "yyyy/MM/dd")
