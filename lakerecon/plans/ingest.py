"""Incremental ingest of a table whose payload column is a JSON string."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.align import tag
from ..functions.payload import PAYLOAD, flatten_payload, is_bad, quarantine_rows, unbox
from ..model import IngestSpec
from ..operators.layout import grow_partitions
from ..operators.stats import counted
from ..sinks.files import MICROSECONDS, write_history, write_raw
from ..sources.files import has_rows
from ..sources.increments import HighWater, highest_key, read_increment, read_up_to


@dataclass(frozen=True)
class IngestResult:
    """``read`` is ``written`` plus ``quarantined``; ``unkeyed`` rows are beside them."""

    read: int
    written: int
    quarantined: int
    unkeyed: int = 0


def ingest_history(source: DataFrame, spec: IngestSpec, marks: HighWater, run_date: date) -> IngestResult:
    """Land everything beyond the last mark, quarantine what does not parse, then move the mark.

    The first run takes rows with a null bookmark key like others. No mark covers them, so later runs set aside
    all such rows that they find, beside the quarantine and each time anew (see ``IngestSpec.set_aside_unkeyed``). A mark with a null is not
    kept: the next run then repeats the batch. One pass over the source: the counts and the new mark are observed while the files are written.
    A second pass happens only if there are rows to quarantine, and is bounded by the new mark so
    that it sees the same rows. The mark moves last.
    """
    keys = list(spec.bookmark_keys)
    after, unkeyed = marks.load(), 0
    if after is not None:
        unkeyed = _set_aside(source, spec, keys) if spec.set_aside_unkeyed else 0
        source = source.na.drop(subset=keys)
    fresh = read_increment(source, keys, after)
    if not has_rows(fresh):
        return IngestResult(0, 0, 0, unkeyed)
    if spec.files:
        # A shuffle, so that reading and parsing keep their parallelism.
        parsed = unbox(fresh, spec.payload, spec.payload_schema).repartition(spec.files)
    else:
        slices = fresh.rdd.getNumPartitions() if spec.min_partitions else None
        parsed = unbox(grow_partitions(fresh, spec.min_partitions, slices), spec.payload, spec.payload_schema)
    parsed, seen = counted(parsed, "read", bad=F.count_if(is_bad()), mark=highest_key(keys))
    value = spec.partition_value if spec.partition_value is not None else run_date
    version, value = marks.begin(str(value))
    batch = {spec.batch_column: f"{spec.job}-{version}"} if spec.batch_column else {}
    landed = flatten_payload(parsed.filter(~is_bad()), PAYLOAD, **batch)
    _land(landed, spec.out, spec.partition, value, batch)
    read, bad, mark = (seen.get[n] for n in ("read", "bad", "mark"))
    if bad:
        again = unbox(read_up_to(fresh, keys, mark), spec.payload, spec.payload_schema)
        rejected = tag(quarantine_rows(again, spec.payload), **batch)
        _land(rejected, spec.quarantine, spec.partition, value, batch)
    if all(mark[k] is not None for k in keys):
        marks.commit(mark, source.select(*keys).schema)
    return IngestResult(read, read - bad, bad, unkeyed)


def _set_aside(source: DataFrame, spec: IngestSpec, keys: list[str]) -> int:
    """Keep all rows without a complete key, which no mark can cover, in a place that each run replaces."""
    without = source.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
    place = f"{spec.quarantine.rstrip('/')}-unkeyed"
    if not has_rows(without):
        return 0
    kept, seen = counted(without.withColumn("error", F.lit("bookmark key is null")))
    kept.write.mode("overwrite").options(**MICROSECONDS).json(place)
    return seen.get["rows"]


def _land(rows: DataFrame, root: str, partition: str, value: str, batch: dict[str, str]) -> None:
    rows = rows.withColumn(partition, F.lit(value))
    if batch:
        write_history(rows, root, [partition, *batch], compression="gzip")
    else:
        write_raw(rows, root, [partition])
