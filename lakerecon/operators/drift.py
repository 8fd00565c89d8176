"""Schema drift: what a feed looks like now, against what was registered."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.schemas import as_nullable, as_struct
from ..sources.files import _no_data
from ..sources.listing import list_files


def _paths(kind: DataType, prefix: str = "", nullable: bool = True):
    """(path, type, nullable) of every field; containers appear and are descended into."""
    if prefix:
        yield prefix, kind.typeName() if isinstance(kind, (StructType, ArrayType, MapType)) else kind.simpleString(), nullable
    if isinstance(kind, StructType):
        for f in kind:
            yield from _paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name, f.nullable)
    elif isinstance(kind, ArrayType):
        yield from _paths(kind.elementType, f"{prefix}[]", kind.containsNull)
    elif isinstance(kind, MapType):
        yield from _paths(kind.keyType, f"{prefix}.key", False)
        yield from _paths(kind.valueType, f"{prefix}.value", kind.valueContainsNull)


def schema_diff(spark: SparkSession, registered: StructType | str, observed: StructType | str) -> DataFrame:
    """Fields added, removed or changed, one row each; no rows when the schemas agree."""
    old = {p: (t, n) for p, t, n in _paths(as_struct(registered))}
    new = {p: (t, n) for p, t, n in _paths(as_struct(observed))}
    rows = []
    for path in sorted({*old, *new}):
        before, after = old.get(path), new.get(path)
        if before != after:
            change = "added" if before is None else "removed" if after is None else "changed"
            rows.append((path, change, *(before or (None, None)), *(after or (None, None))))
    columns = "path string, change string, old_type string, old_nullable boolean, new_type string, new_nullable boolean"
    return spark.createDataFrame(rows, columns)


def latest_schema(spark: SparkSession, root: str, fmt: str = "json") -> StructType | None:
    """Schema of the most recently changed file below ``root``; ties go to the greatest path."""
    newest = list_files(spark, root).agg(
        F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    ).first()["path"]
    return spark.read.format(fmt).load(newest).schema if newest else None


def payload_schema(df: DataFrame, column: str) -> StructType:
    """Schema covering every JSON object in a text column, found in one distributed aggregation.

    Text that is not JSON does not contribute.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        raise ValueError(f"{column} does not hold JSON objects but {found}")
    return StructType.fromDDL(f"payload {found.replace('OBJECT<', 'STRUCT<')}")["payload"].dataType


def schemas_by_partition(lines: DataFrame, column: str, by: str) -> DataFrame:
    """``by`` and ``schema``, the DDL that covers the JSON objects in a text column, found for all partitions in one pass.

    Text that is not a JSON object does not contribute; partitions without one are left out.
    """
    found = lines.groupBy(by).agg(F.schema_of_variant_agg(F.try_parse_json(column)).alias("s"))
    return found.filter(F.startswith("s", F.lit("OBJECT<"))).select(by, F.regexp_replace("s", "OBJECT<", "STRUCT<").alias("schema"))


class SchemaRegistry:
    """Versions of each feed's schema, in an append-only Parquet table.

    ``observed`` keeps schemas as they arrive, ``reader`` their all-nullable form used for reading.
    """

    OBSERVED, READER = "observed", "reader"
    COLUMNS = "feed string, kind string, version bigint, schema string, saved_at timestamp_ntz"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _latest(self, feed: str, kind: str):
        try:
            known = self.spark.read.schema(self.COLUMNS).parquet(self.path)
        except AnalysisException as error:
            if _no_data(error):
                return None
            raise
        row = known.filter((F.col("feed") == feed) & (F.col("kind") == kind)).agg(
            F.max_by(F.struct("version", "schema"), "version").alias("r")
        )
        return row.first()["r"]

    def latest(self, feed: str, kind: str = READER) -> StructType | None:
        row = self._latest(feed, kind)
        return StructType.fromJson(json.loads(row["schema"])) if row else None

    def versions(self, feed: str) -> DataFrame:
        return self.spark.read.schema(self.COLUMNS).parquet(self.path).filter(F.col("feed") == feed)

    def observed(self, feed: str) -> list[StructType]:
        """All versions that were observed, oldest first."""
        rows = self.versions(feed).filter(F.col("kind") == self.OBSERVED).orderBy("version").collect()
        return [StructType.fromJson(json.loads(r["schema"])) for r in rows]

    def save(self, feed: str, kind: str, schema: StructType, at: datetime) -> int:
        return self._append(feed, {kind: schema}, at)[kind]

    def reader_schema(self, feed: str, observed: StructType, at: datetime) -> StructType:
        """The schema to read with; registers both forms first when ``observed`` is new."""
        reader = as_nullable(observed)
        if not (self._known(feed, self.OBSERVED, observed) and self._known(feed, self.READER, reader)):
            self._append(feed, {self.OBSERVED: observed, self.READER: reader}, at)
        return reader

    def _known(self, feed: str, kind: str, schema: StructType) -> bool:
        """Whether a schema is among all versions, so that schemas that take turns are not saved again."""
        try:
            known = self.spark.read.schema(self.COLUMNS).parquet(self.path)
        except AnalysisException as error:
            if _no_data(error):
                return False
            raise
        return not known.filter((F.col("feed") == feed) & (F.col("kind") == kind) & (F.col("schema") == schema.json())).isEmpty()

    def _append(self, feed: str, schemas: dict[str, StructType], at: datetime) -> dict[str, int]:
        """All of them or none: one file. Gives the version of each kind."""
        rows = []
        for kind, schema in schemas.items():
            last = self._latest(feed, kind)
            rows.append((feed, kind, last["version"] + 1 if last else 1, schema.json(), at))
        self.spark.createDataFrame(rows, self.COLUMNS).coalesce(1).write.mode("append").parquet(self.path)
        return {kind: version for _, kind, version, *_ in rows}
