"""Compaction by whole files: small files are packed into balanced bins, and each bin becomes one file.

No row moves between executors. The bins of a partition are planned from its listing, in a task of its own: the largest file
comes first, and each goes to the bin that is lightest so far. So two bins never differ by more than the largest file.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructType

from ..model import CompactionSpec
from ..session import materialise
from ..sinks.files import write_history
from ..sources.files import MERGEABLE, has_rows, read_events, read_partitions
from ..sources.listing import list_files, list_partitions
from .compaction import MAX_SCANS, _distinct_roots, due_partitions, own_tasks
from .layout import compaction_plan, pending_partitions
from .stats import counted


@dataclass(frozen=True)
class PackedPartition:
    """What became of one partition; ``planned`` and ``written`` differ only by bins whose files hold no rows."""

    value: date
    planned: int
    written: int
    smallest_bin: int
    largest_bin: int
    largest_input: int


@dataclass(frozen=True)
class PackedResult:
    partitions: tuple[PackedPartition, ...]
    rows: int

    @property
    def files(self) -> int:
        return sum(p.written for p in self.partitions)


def pack(lengths: list[int], bins: int) -> list[int]:
    """The bin of each length: the longest first, into the bin that holds least; equal ones in their order."""
    heap, found = [(0, i) for i in range(bins)], [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        load, place = heapq.heappop(heap)
        found[i] = place
        heapq.heappush(heap, (load + lengths[i], place))
    return found


def pack_files(files: DataFrame, by: str) -> DataFrame:
    """``files`` (path, length, the partition ``by`` and its number of ``bins``) with the ``bin`` of each file.

    Files are ordered by path before they are packed, so the bins do not depend on how the listing arrives. A task holds
    the listing of a partition, not its data.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("path")
        bins = pack(table.column("length").to_pylist(), table.column("bins")[0].as_py())
        return table.append_column("bin", pa.array(bins, pa.int32()))

    schema = StructType([*files.select("path", "length", by, "bins").schema.fields]).add("bin", IntegerType())
    return files.select("path", "length", by, "bins").groupBy(by).applyInArrow(run, schema)


def _bin_counts(spark: SparkSession, source: str, listing: DataFrame, values: list[date], spec: CompactionSpec) -> DataFrame:
    """Number of bins per partition: by bytes, or by rows and tiers as in ``compaction_plan``; never more than it has files."""
    sized = listing.groupBy(spec.partition).agg(F.count("*").alias("inputs"), F.sum("length").alias("bytes"))
    if spec.bytes_per_file:
        wanted = sized.withColumn("bins", F.ceil(F.col("bytes") / spec.bytes_per_file))
    else:
        # rows of one column's worth: the reader drops what a count does not need
        rows = read_partitions(spark, source, values, spec.source_format, spec.schema, spec.partition)
        planned = compaction_plan(rows, spec.partition, spec.rows_per_file, spec.tiers, spec.max_rows_per_file)
        wanted = sized.join(planned.withColumnRenamed("files", "bins"), spec.partition)
    return wanted.select(spec.partition, F.greatest(F.lit(1), F.least("bins", "inputs")).cast("int").alias("bins"))


def _jobs(packed: DataFrame, partition: str) -> Iterator[list[tuple[date, list[list[str]]]]]:
    """Partitions with the paths of their bins, some at a time: each bin is a scan of its own, and a partition one job's."""
    job, scans = [], 0
    rows = packed.select(partition, "bin", "path").orderBy(partition, "bin", "path").toLocalIterator()
    for value, files in groupby(rows, key=lambda r: r[0]):
        bins = [[r["path"] for r in same] for _, same in groupby(files, key=lambda r: r["bin"])]
        if job and scans + len(bins) > MAX_SCANS:
            yield job
            job, scans = [], 0
        job.append((value, bins))
        scans += len(bins)
    if job:
        yield job


def compact_packed(
    spark: SparkSession,
    source: str,
    target: str,
    spec: CompactionSpec = CompactionSpec(),
    partitions: Iterable[date] | None = None,
) -> PackedResult:
    """Rewrite dated directories of ``source`` into ``target``, whole files together, one file for each bin.

    Partitions are those due by ``spec.strategy``, or the given ones; each is replaced whole, so a repeated run gives the
    same. Every file belongs to one bin and is read by one task, whatever its size, so bins are for files that are smaller
    than the files wanted. Empty files are left out. The result tells the files that are there afterwards.
    """
    _distinct_roots(source, target)
    if partitions is None:
        both = [list_partitions(spark, root, spec.partition) for root in (source, target)]
        partitions = due_partitions(pending_partitions(*both, spec.strategy, spec.partition), spec.partition)
    values = sorted(set(partitions))
    day = F.regexp_extract("path", rf"/{spec.partition}=([^/]+)/", 1).try_cast(DateType())
    listing = list_files(spark, source).filter("length > 0").withColumn(spec.partition, day)
    listing = listing.filter(F.col(spec.partition).isin(values))
    if not values or not has_rows(listing):
        return PackedResult((), 0)
    packed = materialise(pack_files(listing.join(_bin_counts(spark, source, listing, values, spec), spec.partition), spec.partition), "packed")
    merge = {"mergeSchema": "true"} if spec.schema is None and spec.source_format in MERGEABLE else {}
    shape = read_partitions(spark, source, values, spec.source_format, spec.schema, spec.partition, **merge)
    schema = spec.schema or StructType([f for f in shape.schema if f.name != spec.partition])
    fmt, rows = spec.target_format or spec.source_format, 0
    for job in _jobs(packed, spec.partition):
        scans = [
            read_events(spark, paths, spec.source_format, schema).coalesce(1).withColumn(spec.partition, F.lit(value))
            for value, bins in job
            for paths in bins
        ]
        frame, seen = counted(reduce(DataFrame.unionAll, scans))
        with own_tasks(spark):
            write_history(frame.drop(*spec.drop), target, [spec.partition], fmt, **spec.write_options)
        rows += seen.get["rows"]
    return PackedResult(tuple(_told(spark, target, packed, values, spec)), rows)


def _told(spark: SparkSession, target: str, packed: DataFrame, values: list[date], spec: CompactionSpec) -> list[PackedPartition]:
    """Per partition the bins that were planned and the files that a listing of the target finds."""
    bins = packed.groupBy(spec.partition, "bin").agg(F.sum("length").alias("bytes"), F.max("length").alias("largest"))
    planned = bins.groupBy(spec.partition).agg(
        F.count("*").alias("planned"), F.min("bytes").alias("least"), F.max("bytes").alias("most"), F.max("largest").alias("largest")
    )
    written = list_partitions(spark, target, spec.partition, values).select(spec.partition, F.col("files").alias("written"))
    found = planned.join(written, spec.partition, "left").orderBy(spec.partition)
    return [PackedPartition(r[0], r["planned"], r["written"] or 0, r["least"], r["most"], r["largest"]) for r in found.collect()]
