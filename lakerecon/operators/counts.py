"""Count-level reconciliation of two grouped frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.schemas import wall_clock
from ..functions.times import eastern_text
from ..model import AuditStamp
from ..session import materialise

# The two results of a control.
SUCCESS = "success"
FAILURE = "Failure"

#: Groups up to which those to be opened are broadcast, and values up to which the scan is told of the first column's.
MAX_OPEN = 100_000
MAX_PUSHED = 1_000


def count_recon(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    control: str,
    table: str,
    left_prefix: str = "left_",
    right_prefix: str = "right_",
    count: str = "count",
    null_safe: bool = False,
) -> DataFrame:
    """Full outer join of two sets of counts, with the difference and a status per group.

    With one key both sides share its plain name; with several keys each side has its own prefixed
    copy. The counts are always prefixed. A group present on one side only has a null difference
    and fails. A null key matches nothing unless ``null_safe``.
    """
    left_count, right_count = f"{left_prefix}{count}", f"{right_prefix}{count}"
    if len(keys) == 1:
        joined = _join_on_shared(left, right, keys[0], null_safe)
    else:
        pairs = [(F.col(f"{left_prefix}{k}"), F.col(f"{right_prefix}{k}")) for k in keys]
        same = [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs]
        joined = left.join(right, reduce(lambda x, y: x & y, same), "full_outer")
    a, b = F.col(left_count).cast("long"), F.col(right_count).cast("long")
    return joined.withColumns(
        {
            "ctrl_name": F.lit(control),
            "table_name": F.lit(table),
            "differences": a - b,
            "run_status": F.when(a - b == 0, SUCCESS).otherwise(FAILURE),
            "present_in": F.when(b.isNull(), "left").when(a.isNull(), "right").otherwise("both"),
        }
    )


def drill_counts(left: DataFrame, right: DataFrame, columns: Sequence[str], control: str, table: str) -> DataFrame:
    """Counts of rows from the total down to groups of all ``columns``, opening only those groups that differ.

    ``columns`` go from coarse to fine. The total and all groups of the first column are counted; a group whose counts differ is
    counted by the next column, the others are not looked at again. So with a directory's value as the first column, later levels read only directories that
    differ, and no level shuffles more than partial counts. Groups that differ by as many rows to either side cancel out
    above: counts of a level prove nothing about the levels below where they agree. Nulls form a group like others.

    One row per group looked at: ``level`` (0 for the total), the columns (null below the level), both counts (0 where a side
    has no such group), ``differences``, ``run_status`` and ``present_in``.
    """
    levels, opened = [], None
    for depth in range(len(columns) + 1):
        keys = list(columns[:depth])
        sides = [_opened(side, opened, keys[:-1]).groupBy(*keys).agg(F.count("*").alias("n")) for side in (left, right)]
        below = {c: left.schema[c].dataType for c in columns[depth:]}
        level = materialise(_level(*sides, keys, below, control, table), "drill")
        levels.append(level)
        opened = failed_groups(level).select(*keys)
        if keys and opened.isEmpty():
            break
    return reduce(DataFrame.unionByName, levels)


def _same(keys: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys], F.lit(True))


def _opened(df: DataFrame, groups: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The rows of ``groups``; a plain filter for the scan too where the first column has few values."""
    if groups is None or not keys:
        return df
    first = [r[0] for r in groups.select(keys[0]).distinct().limit(MAX_PUSHED + 1).collect()]
    if len(first) <= MAX_PUSHED:
        wanted = F.col(keys[0]).isin([v for v in first if v is not None])
        df = df.filter(wanted | F.col(keys[0]).isNull() if None in first else wanted)
        if len(keys) == 1:
            return df
    groups = groups.select(*(F.col(k).alias(f"_open_{k}") for k in keys))
    few = groups.limit(MAX_OPEN + 1).count() <= MAX_OPEN
    return df.join(F.broadcast(groups) if few else groups, _same(keys, "_open_"), "left_semi")


def _level(left: DataFrame, right: DataFrame, keys: Sequence[str], below: Mapping[str, DataType], control: str, table: str) -> DataFrame:
    other = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), F.col("n").alias("_r_n"))
    if keys:
        both = left.join(other, _same(keys, "_r_"), "full_outer")
    else:
        both = left.crossJoin(other)  # one row each
    a, b = F.coalesce("n", F.lit(0)), F.coalesce("_r_n", F.lit(0))
    mine, theirs = F.col("n") > 0, F.col("_r_n") > 0
    return both.select(
        F.lit(len(keys)).alias("level"),
        *(F.when(F.col("n").isNotNull(), F.col(k)).otherwise(F.col(f"_r_{k}")).alias(k) for k in keys),
        *(F.lit(None).cast(kind).alias(c) for c, kind in below.items()),
        a.alias("left_count"),
        b.alias("right_count"),
        (a - b).alias("differences"),
        F.when(a == b, SUCCESS).otherwise(FAILURE).alias("run_status"),
        F.when(mine & theirs, "both").when(mine, "left").when(theirs, "right").otherwise("neither").alias("present_in"),
        F.lit(control).alias("ctrl_name"),
        F.lit(table).alias("table_name"),
    )


def _join_on_shared(left: DataFrame, right: DataFrame, key: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, key, "full_outer")
    other = f"_right_{key}"
    joined = left.join(right.withColumnRenamed(key, other), F.col(key).eqNullSafe(F.col(other)), "full_outer")
    return joined.withColumn(key, F.coalesce(key, other)).drop(other)


def failed_groups(recon: DataFrame) -> DataFrame:
    """The groups a control did not pass."""
    return recon.filter(F.col("run_status") == FAILURE)


def recon_alerts(recon: DataFrame, fields: Sequence[str], stamp: AuditStamp) -> DataFrame:
    """One JSON text per group: control, difference, chosen fields, run id, run time in both zones."""
    at = wall_clock(stamp.at)
    body = F.struct(
        F.col("ctrl_name").alias("rule_name"),
        "differences",
        *fields,
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("job_run_time"),
        eastern_text(at).alias("job_run_time_est"),
        F.lit("reconciliation_data").alias("content_type"),
        F.lit(stamp.run_id).alias("run_id"),
    )
    return recon.select("ctrl_name", F.to_json(body).alias("alert"))
