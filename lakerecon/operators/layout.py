"""File layout: how many files a partition should have, and which partitions are due."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import MAX_ROWS_PER_FILE, PARTITION_COLUMN, ROWS_PER_FILE

STRATEGIES = ("missing", "from_latest", "from_second_latest")


def compaction_plan(
    df: DataFrame,
    by: str | Sequence[str],
    rows_per_file: int = ROWS_PER_FILE,
    tiers: Sequence[tuple[int | None, int]] | None = None,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> DataFrame:
    """Rows and number of files per partition.

    By default ``ceil(rows / rows_per_file)``. ``tiers`` is a list of (rows up to, files) instead,
    the last bound being None; partitions so large that a tier would exceed ``max_rows_per_file``
    get more files.
    """
    counted = df.groupBy(*([by] if isinstance(by, str) else by)).agg(F.count("*").alias("rows"))
    return counted.withColumn("files", files_for(F.col("rows"), rows_per_file, tiers, max_rows_per_file))


def files_for(rows, rows_per_file=ROWS_PER_FILE, tiers=None, max_rows_per_file=MAX_ROWS_PER_FILE):
    """Number of files for a row count, at least one."""
    if tiers is None:
        return F.greatest(F.lit(1), F.ceil(rows / rows_per_file)).cast("long")
    if tiers[-1][0] is not None or any(bound is None for bound, _ in tiers[:-1]):
        raise ValueError("exactly the last tier must be unbounded")
    chosen = F.lit(tiers[-1][1])
    for bound, files in reversed(tiers[:-1]):
        chosen = F.when(rows <= bound, files).otherwise(chosen)
    return F.greatest(chosen, F.ceil(rows / max_rows_per_file)).cast("long")


def pending_partitions(
    source: DataFrame, target: DataFrame, strategy: str = "from_second_latest", partition: str = PARTITION_COLUMN
) -> DataFrame:
    """Source partitions that have to be processed, from two listings.

    ``missing``: not in the target. ``from_latest``: from the latest target partition on.
    ``from_second_latest``: from the one before it on, so that late files of the last two
    partitions are picked up (from the only one if there is just one). With an empty target the
    latter two return everything.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "missing":
        return source.join(target.select(partition).distinct(), partition, "left_anti")
    mark = partition_mark(target, strategy, partition).scalar()
    return source.filter(mark.isNull() | (F.col(partition) >= mark))


def partition_mark(target: DataFrame, strategy: str, partition: str = PARTITION_COLUMN) -> DataFrame:
    """The target partition to start from, as one row; null when the target is empty."""
    steps = {"from_latest": 1, "from_second_latest": 2}[strategy]
    newest = target.select(partition).distinct().orderBy(F.desc(partition)).limit(steps)
    return newest.agg(F.min(partition).alias("mark"))


def cap_partitions(df: DataFrame, n: int | None) -> DataFrame:
    """At most ``n`` tasks, without a shuffle; never raises the number.

    The step that produced the frame also runs with ``n`` tasks, so use it to limit database
    connections, not to size files.
    """
    return df.coalesce(n) if n else df


def grow_partitions(df: DataFrame, n: int | None, current: int | None = None) -> DataFrame:
    """Spread rows over ``n`` tasks before heavy parsing, unless there are that many already."""
    return df.repartition(n) if n and (current is None or current < n) else df
