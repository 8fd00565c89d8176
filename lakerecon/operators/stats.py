"""Counts that describe a feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def group_names(columns: Sequence[str]) -> list[str]:
    """A nested column is named by its last part, or by its whole path with underscores where two end alike."""
    names = [c.split(".")[-1] for c in columns]
    return [c.replace(".", "_") if names.count(n) > 1 else n for c, n in zip(columns, names)]


def landing_stats(df: DataFrame, columns: Sequence[str], total: bool = False) -> DataFrame:
    """Rows per group of (possibly nested) columns; ``total`` adds one grand-total row.

    Columns are named as ``group_names`` says. The total is taken from the group counts, not from the rows, so the rows are not doubled.
    """
    names = group_names(columns)
    grouped = df.groupBy(*[F.col(c).alias(n) for c, n in zip(columns, names)]).agg(F.count("*").alias("rows"))
    if not total:
        return grouped
    return grouped.groupingSets([names, []], *names).agg(
        (F.grouping_id() != 0).alias("is_total"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row frame."""
    return df.agg(F.count("*").alias("rows"))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of distinct key tuples; null keys count as a value."""
    return df.select(*keys).distinct().agg(F.count("*").alias("keys"))


def counted(df: DataFrame, name: str = "rows", **extra) -> tuple[DataFrame, Observation]:
    """Count rows while another action runs, without a job of its own.

    Put it last before the write: there each task's count is taken exactly once, even if tasks are
    retried, which does not hold above a later shuffle.
    """
    seen = Observation()
    metrics = [expression.alias(alias) for alias, expression in extra.items()]
    return df.observe(seen, F.count(F.lit(1)).alias(name), *metrics), seen
