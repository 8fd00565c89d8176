"""Row-level comparison of a source with its copy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hotkeys import HotKeys, find_hot_keys, join_to_unique, same_key_types

AUTO = "auto"
KEY = "_key"

# The words around the two values in a difference text.
SOURCE_WORD = "src1"
TARGET_WORD = "tgt1"

_SIDES = (("_src", "src_value"), ("_tgt", "tgt_value"))


def missing_records(
    source: DataFrame, target: DataFrame, keys: Sequence[str], hot: HotKeys | str | None = AUTO, null_safe: bool = False
) -> DataFrame:
    """Source rows whose key is not in the target.

    The target is reduced to its distinct keys while it is shuffled, so repeated target keys cost
    nothing. ``hot`` takes care of repeated source keys: ``"auto"`` looks for them first, None says
    there are none, as after ``latest_per_key``. A null key equals nothing, hence is always missing,
    unless ``null_safe``.
    """
    source, target = same_key_types(source, target, keys)
    present = target.select(*keys).distinct()
    if null_safe:
        # Inside a struct nulls are equal, and a struct is still a key Spark can hash and sort.
        key = F.struct(*keys).alias(KEY)
        keyed = source.withColumn(KEY, key)
        if hot == AUTO:
            hot = find_hot_keys(keyed, [KEY])
        return join_to_unique(keyed, present.withColumn(KEY, key), [KEY], "left_anti", hot).drop(KEY)
    if hot == AUTO:
        hot = find_hot_keys(source, keys)
    return join_to_unique(source, present, keys, "left_anti", hot)


def _differs(column: str, null_safe: bool) -> Column:
    left, right = F.col(f"_src.{column}"), F.col(f"_tgt.{column}")
    if null_safe:
        return ~left.eqNullSafe(right)
    return F.coalesce(left != right, F.lit(False))


def compare_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_safe: bool = True,
    hot: HotKeys | str | None = AUTO,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Pair source and target rows by key and compare ``columns``.

    ``source`` must hold one row per key (see ``latest_per_key``); the target may repeat keys, and
    each of its rows is compared. Result: the keys, both sides as structs ``_src`` and ``_tgt``,
    ``present_in`` (both, source, target) and ``is_mismatch``, which is true only for paired rows
    with a differing column. With ``null_safe`` a null differs from a value; without, it does not.
    ``carry`` are the columns the structs hold, by default the compared ones.

    ``hot`` takes care of keys repeated many times in the target, see ``missing_records``.
    """
    carry = list(dict.fromkeys([*(carry or ()), *columns]))
    source, target = same_key_types(source, target, keys)
    src = source.select(*keys, F.struct(*carry).alias("_src"))
    tgt = target.select(*keys, F.struct(*carry).alias("_tgt"))
    if hot == AUTO:
        hot = find_hot_keys(target, keys)
    if hot:
        # A full outer join cannot be spread: each target row looks up its source row, and the
        # source rows nobody looked up are added.
        paired = join_to_unique(tgt, src, keys, "left", hot).select(*keys, "_src", "_tgt")
        alone = missing_records(src, tgt, keys, hot=None).withColumn(
            "_tgt", F.lit(None).cast(tgt.schema["_tgt"].dataType)
        )
        joined = paired.unionByName(alone)
    else:
        joined = src.join(tgt, list(keys), "full_outer")
    both = F.col("_src").isNotNull() & F.col("_tgt").isNotNull()
    any_differs = reduce(lambda a, b: a | b, [_differs(c, null_safe) for c in columns])
    return joined.withColumns(
        {
            "present_in": F.when(both, "both").when(F.col("_src").isNotNull(), "source").otherwise("target"),
            "is_mismatch": both & any_differs,
        }
    )


def _entries(columns: Sequence[str], null_safe: bool) -> Column:
    """The columns in which a paired row differs: an array of name and both values as text."""
    both = [F.struct(F.lit(c).alias("column_name"), *(F.col(f"{side}.{c}").cast("string").alias(name) for side, name in _SIDES)) for c in columns]
    return F.array_compact(F.array(*(F.when(_differs(c, null_safe), entry) for c, entry in zip(columns, both, strict=True))))


def column_diff(compared: DataFrame, keys: Sequence[str], columns: Sequence[str], null_safe: bool = True) -> DataFrame:
    """One row per differing column of a paired row: keys, column name, both values as text."""
    return compared.filter("is_mismatch").select(*keys, F.inline(_entries(columns, null_safe)))


def diff_text(
    compared: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    table: str,
    day: date,
    null_safe: bool = False,
) -> DataFrame:
    """The differences of ``column_diff`` with those of a row in a single text, a value that is null left out."""
    told = F.transform(
        _entries(columns, null_safe),
        lambda e: F.concat_ws(" ", e["column_name"], F.lit(SOURCE_WORD), e["src_value"], F.lit(TARGET_WORD), e["tgt_value"]),
    )
    key_text = F.array_join(F.array(*(F.col(k).cast("string") for k in keys)), ",")
    named = {"table_name": F.lit(table), "primary_key": F.lit(",".join(keys)), "primary_key_id": key_text, "date": F.lit(str(day))}
    return compared.filter("is_mismatch").select(F.array_join(told, " ").alias("difference"), *keys, *(c.alias(n) for n, c in named.items()))


#: A boolean column beside the keys: the key did not fit the target's type, so the row is a record of its own.
STRAY = "_stray"


def records_and_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many records, and how many rows ``latest_per_key`` makes of them.

    Both come from one count per key, which combines before the shuffle. Rows marked STRAY count one by one.
    """
    by = [*keys, STRAY] if STRAY in source.columns else list(keys)
    per_key = source.groupBy(*by).agg(F.count("*").alias("n"))
    rows = F.sum(F.when(F.col(STRAY), F.col("n")).otherwise(1)) if STRAY in source.columns else F.count("*")
    zero = F.lit(0).cast("long")
    return per_key.agg(F.coalesce(F.sum("n"), zero).alias("source_record_count"), F.coalesce(rows, zero).alias("source_row_count"))


def recon_summary(
    compared: DataFrame, source: DataFrame, keys: Sequence[str], table: str, source_columns: int, target_columns: int
) -> DataFrame:
    """One row: how many rows and columns each side has, and how many rows are missing or differ.

    ``source`` is the source before ``latest_per_key``, see ``records_and_rows``.
    """
    left = records_and_rows(source, keys)
    right = compared.agg(
        F.count_if(F.col("present_in") != "source").alias("target_row_count"),
        F.count_if(F.col("present_in") == "source").alias("missing_record_count"),
        F.count_if("is_mismatch").alias("mismatched_record_count"),
    )
    counts = left.unionByName(right, allowMissingColumns=True)
    row = counts.agg(*[F.max(c).alias(c) for c in counts.columns])
    return row.select(
        F.lit(table).alias("table_name"),
        "source_record_count",
        "source_row_count",
        "target_row_count",
        (F.col("source_row_count") - F.col("target_row_count")).alias("difference_total_row_count"),
        F.lit(source_columns).alias("source_column_count"),
        F.lit(target_columns).alias("target_column_count"),
        F.lit(source_columns - target_columns).alias("difference_total_column_count"),
        "missing_record_count",
        "mismatched_record_count",
    )
