"""Compaction of a feed whose schema is registered and may change."""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lattice import reader_lattice
from ..model import CompactionSpec
from ..operators.compaction import NOTHING, CompactionResult, compact
from ..operators.drift import SchemaRegistry, schemas_by_partition
from ..operators.layout import pending_partitions
from ..sources.files import MERGEABLE, read_partitions
from ..sources.listing import list_partitions

# Formats whose files state their own schema, so that one file tells it.
SELF_DESCRIBING = ("avro", "parquet", "orc")


def observed_schemas(
    spark: SparkSession, source: str, spec: CompactionSpec, days: list[date]
) -> list[tuple[StructType, list[date]]]:
    """The schemas of the given partitions, oldest first, each with its partitions.

    Parquet and ORC: the schemas of all files of a partition are merged, in tasks, and a conflict
    fails the run. Avro: its newest file decides. JSON: one inference over all partitions.
    """
    if spec.source_format not in SELF_DESCRIBING:
        df = read_partitions(spark, source, days, spec.source_format, None, spec.partition)
        return [(df.drop(spec.partition).schema, days)]
    listed = list_partitions(spark, source, spec.partition, days).select(spec.partition, "newest").collect()
    found: dict[str, list[date]] = defaultdict(list)
    for day, newest in sorted(listed):
        if spec.source_format in MERGEABLE:
            schema = read_partitions(spark, source, [day], spec.source_format, None, spec.partition, mergeSchema="true").schema
        else:
            schema = spark.read.format(spec.source_format).load(newest).schema
        found[StructType([f for f in schema if f.name != spec.partition]).json()].append(day)
    return [(StructType.fromJson(json.loads(text)), members) for text, members in found.items()]


def compact_registered(
    spark: SparkSession,
    source: str,
    target: str,
    registry: SchemaRegistry,
    feed: str,
    at: datetime,
    spec: CompactionSpec = CompactionSpec(),
) -> CompactionResult:
    """Compact what is due, reading each partition with its registered all-nullable schema.

    A schema seen for the first time is registered.
    """
    listing = list_partitions(spark, source, spec.partition)
    due = pending_partitions(listing, list_partitions(spark, target, spec.partition), spec.strategy, spec.partition)
    days = sorted(r[0] for r in due.select(spec.partition).collect())
    done = NOTHING
    for schema, members in observed_schemas(spark, source, spec, days) if days else []:
        reader = registry.reader_schema(feed, schema, at)
        part = compact(spark, source, target, replace(spec, schema=reader), partitions=members)
        done = CompactionResult(
            done.partitions + part.partitions, done.rows + part.rows, done.files + part.files, done.planned + part.planned
        )
    return done


def compact_evolved(
    spark: SparkSession,
    source: str,
    target: str,
    registry: SchemaRegistry,
    feed: str,
    at: datetime,
    spec: CompactionSpec = CompactionSpec(),
) -> tuple[CompactionResult, tuple[str, ...]]:
    """Compact JSON partitions that are due, all of them by the least schema that reads every version of the feed.

    The schemas of all due partitions are observed in one pass and registered where they are new; those of earlier runs are
    taken in. So a column that was a whole number, then a fraction, then text, is read as text throughout, and none is lost.
    Partitions written by earlier runs keep the narrower types they were written with. Also gives the paths at which
    versions conflict: their values are kept as JSON text.
    """
    if spec.source_format != "json":
        raise ValueError("files of other formats state their own schema, see compact_registered")
    due = pending_partitions(list_partitions(spark, source, spec.partition), list_partitions(spark, target, spec.partition), spec.strategy, spec.partition)
    days = sorted(r[0] for r in due.select(spec.partition).collect())
    if not days:
        return NOTHING, ()
    lines = read_partitions(spark, source, days, "text", "value STRING", spec.partition)
    seen = schemas_by_partition(lines, "value", spec.partition).groupBy("schema").agg(F.min(spec.partition).alias("first"))
    for row in seen.orderBy("first", "schema").collect():
        registry.reader_schema(feed, StructType.fromDDL(f"payload {row['schema']}")["payload"].dataType, at)
    joined = reader_lattice(registry.observed(feed))
    return compact(spark, source, target, replace(spec, schema=joined.type), partitions=days), joined.conflicts
