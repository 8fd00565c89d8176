"""Small-file compaction of dated directories.

Partitions are planned from their row counts and written many at a time. Where a large partition
consists of small, even files, whole files are put together and no row moves between executors;
otherwise rows are spread evenly over the planned files.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..model import FIXED_FILES, CompactionSpec
from ..sinks.files import MICROSECONDS, write_history
from ..sources.files import MERGEABLE, read_calendar, read_events, read_partitions
from ..sources.listing import list_calendar, list_files, list_partitions
from .layout import compaction_plan, files_for, partition_mark, pending_partitions
from .stats import counted

# Write tasks per job: the blocks of a shuffle grow with the product of its two sides.
MAX_TASKS = 20_000
# Write tasks that a job has at least if it has as many files; what a task tells the driver takes some 13 KB.
LEAST_TASKS = 256
# Partitions per job when whole files are put together, each being a scan of its own.
MAX_SCANS = 64
# The per-partition plan of a job is broadcast up to this many partitions (about 4 MB).
MAX_BROADCAST_PARTITIONS = 100_000
# Below this size a partition's scan of its own costs more than shuffling it.
WHOLE_BYTES = 1024 * 1024 * 1024
# What one read task takes of a file that can be split.
SPLIT_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class PartitionPlan:
    """``rows`` is None when the plan was made from file sizes."""

    value: date
    rows: int | None
    files: int
    whole: bool = False


@dataclass(frozen=True)
class CompactionResult:
    """``files`` are there after the run, by a listing of the target; ``planned`` were wanted."""

    partitions: tuple[date, ...]
    rows: int
    files: int
    planned: int = 0


NOTHING = CompactionResult((), 0, 0, 0)


def _distinct_roots(source: str, target: str) -> None:
    a, b = (p.rstrip("/") + "/" for p in (source, target))
    if a.startswith(b) or b.startswith(a):
        raise ValueError("compaction must not overwrite the directory it reads")


def due_partitions(listing: DataFrame, partition: str) -> list[date]:
    """Bring a listing's partition values to the driver: one small value per directory."""
    return sorted(r[0] for r in listing.select(partition).distinct().collect())


def _fit(files: int, inputs: int, size: int, largest: int, shuffle: bool | None) -> tuple[int, bool]:
    """(number of files, put whole input files together?).

    Unless rows are to be spread, there are never more files than the input has pieces. Whole files
    are even enough when none is larger than two average output files, and worth it for partitions
    of some size.
    """
    if shuffle:
        return files, False
    files = min(files, max(inputs, math.ceil(size / SPLIT_BYTES)))
    return files, shuffle is False or (size >= WHOLE_BYTES and largest * files <= 2 * size)


def _plan(df: DataFrame, sizes: DataFrame, spec: CompactionSpec) -> list[PartitionPlan]:
    """One small row per partition, from the listing and, unless sizes decide, the row counts."""
    listed = {r[spec.partition]: (r["files"], r["bytes"], r["largest"]) for r in sizes.collect()}
    if spec.bytes_per_file:
        wanted = [(day, None, max(1, math.ceil(sized[1] / spec.bytes_per_file))) for day, sized in listed.items()]
    else:
        counted_rows = compaction_plan(df, spec.partition, spec.rows_per_file, spec.tiers, spec.max_rows_per_file)
        wanted = [(r[spec.partition], r["rows"], r["files"]) for r in counted_rows.collect()]
    plan = []
    for value, rows, files in wanted:
        if value not in listed:
            raise ValueError(f"rows with {spec.partition} = {value} lie outside dated directories")
        files, whole = _fit(files, *listed[value], spec.shuffle)
        plan.append(PartitionPlan(value, rows, files, whole))
    return sorted(plan, key=lambda p: p.value)


def _shared_tasks(most: int, files: int) -> int:
    """Tasks for partitions of ``most`` and fewer files, ``files`` together, if a task writes one file in each of many."""
    return max(most, min(files, LEAST_TASKS))


def _jobs(plan: Sequence[PartitionPlan], most_partitions: int) -> Iterator[list[PartitionPlan]]:
    """Group partitions into jobs of bounded size; a partition is never divided."""
    job, most, files = [], 0, 0
    for part in plan:
        most, files = max(most, part.files), files + part.files
        if job and ((files if part.whole else _shared_tasks(most, files)) > MAX_TASKS or len(job) == most_partitions):
            yield job
            job, most, files = [], part.files, part.files
        job.append(part)
    if job:
        yield job


def _days_from_mark(done: DataFrame, spec: CompactionSpec, until: date) -> list[date] | None:
    mark = partition_mark(done, spec.strategy, spec.partition).first()["mark"]
    return None if mark is None else [mark + timedelta(days=i) for i in range((until - mark).days + 1)]


def spread_over_files(df: DataFrame, plan: Sequence[PartitionPlan], partition: str, per_task: int = 1) -> DataFrame:
    """Send each row to one of its partition's files, of which a task writes one (or ``per_task``).

    A task writes a file in each of many partitions: there are as many tasks as the partition with the most files
    needs, or ``LEAST_TASKS`` if there are that many files. Every partition owns a range of task numbers, the next
    one going on where it ends; rows take the numbers of their range in turn, so a partition holding most of the
    rows, or many copies of one row, is spread as evenly as any.
    """
    wanted = [math.ceil(part.files / per_task) for part in plan]
    number = _shared_tasks(max(wanted), sum(wanted))
    ranges, offset = [], 0
    for part, tasks in zip(plan, wanted, strict=True):
        ranges.append((part.value, offset, tasks))
        offset = (offset + tasks) % number
    schema = f"`{partition}` {df.schema[partition].dataType.simpleString()}, _offset bigint, _tasks bigint"
    lookup = df.sparkSession.createDataFrame(ranges, schema)
    if len(ranges) <= MAX_BROADCAST_PARTITIONS:
        lookup = F.broadcast(lookup)
    # The row number inside an input split is the same when the split is read again.
    numbered = df.withColumn("_turn", F.monotonically_increasing_id()).join(lookup, partition)
    task = ((F.col("_offset") + F.pmod("_turn", "_tasks")) % number).cast("int").alias("_task")
    return numbered.select(*df.columns, task).repartitionById(number, F.col("_task")).drop("_task")


@contextmanager
def own_tasks(spark: SparkSession) -> Iterator[None]:
    """Scans that are put together keep their tasks; Spark 4.1 and later would run scans of one task each in a single task."""
    name = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


Reader = Callable[[Sequence[date], StructType | str | None], DataFrame]


def _rewrite(
    read: Reader,
    sizes: Callable[[Sequence[date]], DataFrame],
    values: Sequence[date],
    target: str,
    spec: CompactionSpec,
) -> CompactionResult:
    """Count per partition, then write the partitions, each of them once and whole.

    A run that stops half way has finished some partitions; the next run does them again or goes on
    after them, depending on the strategy.
    """
    df = read(values, spec.schema)
    # An inferred schema is inferred once.
    schema = spec.schema or StructType([f for f in df.schema if f.name != spec.partition])
    plan = _plan(df, sizes(values), spec)
    written = 0

    def write(frame: DataFrame, **more: str) -> None:
        nonlocal written
        fmt = spec.target_format or spec.source_format
        frame, seen = counted(frame)
        write_history(frame.drop(*spec.drop), target, [spec.partition], fmt, **spec.write_options, **more)
        written += seen.get["rows"]

    for job in _jobs([p for p in plan if p.whole], MAX_SCANS):
        with own_tasks(df.sparkSession):
            write(reduce(DataFrame.unionAll, [read([p.value], schema).coalesce(p.files) for p in job]))
    for job in _jobs([p for p in plan if not p.whole], MAX_BROADCAST_PARTITIONS):
        files = max(p.files for p in job)
        per_task, limit = math.ceil(files / MAX_TASKS), {}
        if per_task > 1:
            # Only a partition with more files than a job has tasks gets here, and it is alone.
            rows = job[0].rows or read([job[0].value], schema).count()
            limit["maxRecordsPerFile"] = str(max(1, math.ceil(rows / files)))
        write(spread_over_files(read([p.value for p in job], schema), job, spec.partition, per_task), **limit)
    there = list_partitions(df.sparkSession, target, spec.partition, values)
    files = there.agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
    return CompactionResult(tuple(p.value for p in plan), written, files, sum(p.files for p in plan))


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    spec: CompactionSpec = CompactionSpec(),
    partitions: Iterable[date] | None = None,
    until: date | None = None,
) -> CompactionResult:
    """Rewrite ``source`` into ``target`` with few files.

    Incremental mode takes the partitions that are due by ``spec.strategy`` (or ``partitions``) and
    replaces each of them whole, so a repeated run changes nothing. Full mode rewrites everything
    into one flat directory. ``source_format="text"`` moves JSON lines without parsing them.

    With ``until``, the day of the run, a strategy that starts at a target partition lists only the
    days from there on instead of the whole source; later days are left for later runs.
    """
    _distinct_roots(source, target)
    if spec.mode == "full":
        return _compact_full(spark, source, target, spec)
    if partitions is None and until is not None and spec.strategy != "missing":
        partitions = _days_from_mark(list_partitions(spark, target, spec.partition), spec, until)
    if partitions is None:
        due = pending_partitions(
            list_partitions(spark, source, spec.partition),
            list_partitions(spark, target, spec.partition),
            spec.strategy,
            spec.partition,
        )
        partitions = [day for day in due_partitions(due, spec.partition) if until is None or day <= until]
    values = sorted(set(partitions))

    def read(days, schema):
        merge = {"mergeSchema": "true"} if schema is None and spec.source_format in MERGEABLE else {}
        return read_partitions(spark, source, days, spec.source_format, schema, spec.partition, **merge)

    def sizes(days):
        return list_partitions(spark, source, spec.partition, days)

    if not values or read(values, spec.schema or "value STRING") is None:
        return NOTHING
    return _rewrite(read, sizes, values, target, spec)


def _compact_full(spark: SparkSession, source: str, target: str, spec: CompactionSpec) -> CompactionResult:
    merge = {"mergeSchema": "true"} if spec.schema is None and spec.source_format in MERGEABLE else {}
    df = read_events(spark, source, spec.source_format, spec.schema, **merge)
    inputs, size, largest = list_files(spark, source).agg(
        F.count("*"), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.max("length"), F.lit(0))
    ).first()
    if spec.bytes_per_file:
        rows, planned = None, max(1, math.ceil(size / spec.bytes_per_file))
    else:
        planned = files_for(F.col("rows"), spec.rows_per_file, spec.tiers, spec.max_rows_per_file)
        rows, planned = df.agg(F.count("*").alias("rows")).select("rows", planned).first()
    if not inputs or rows == 0:
        return NOTHING
    files, whole = _fit(planned, inputs, size, largest, spec.shuffle)
    fmt = spec.target_format or spec.source_format
    options = {**(MICROSECONDS if fmt in ("json", "csv") else {}), **spec.write_options}
    tasks = min(files, MAX_TASKS)
    if tasks < files:
        options["maxRecordsPerFile"] = str(max(1, math.ceil((df.count() if rows is None else rows) / files)))
    sized, seen = counted(df.coalesce(tasks) if whole else df.repartition(tasks))
    sized.drop(*spec.drop).write.mode("overwrite").options(**options).format(fmt).save(target)
    return CompactionResult((), seen.get["rows"], list_files(spark, target).count(), files)


def rekey_calendar_paths(
    spark: SparkSession,
    root: str,
    days: Iterable[date] | None = None,
    fmt: str = "json",
    schema: StructType | str | None = None,
    partition: str = CompactionSpec.partition,
) -> DataFrame:
    """Rows of ``root/yyyy/mm/dd`` directories with the directory's date as a partition column."""
    return read_calendar(spark, root, days, fmt, schema, partition)


def compact_calendar(
    spark: SparkSession,
    source: str,
    target: str,
    spec: CompactionSpec = CompactionSpec(strategy="from_latest", tiers=FIXED_FILES),
    days: Iterable[date] | None = None,
) -> CompactionResult:
    """Compact ``yyyy/mm/dd`` directories into ``partition=date`` directories."""
    _distinct_roots(source, target)
    if days is None:
        due = pending_partitions(
            list_calendar(spark, source, spec.partition),
            list_partitions(spark, target, spec.partition),
            spec.strategy,
            spec.partition,
        )
        days = due_partitions(due, spec.partition)
    values = sorted(set(days))

    def read(wanted, schema):
        return rekey_calendar_paths(spark, source, wanted, spec.source_format, schema, spec.partition)

    def sizes(wanted):
        return list_calendar(spark, source, spec.partition, wanted)

    return _rewrite(read, sizes, values, target, spec) if values else NOTHING
