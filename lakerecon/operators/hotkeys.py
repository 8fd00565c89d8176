"""Joins that stay balanced when a few keys hold most of the rows.

Adaptive execution splits skewed partitions of some joins, but not of full outer joins, and not
when a window or an aggregate stands between the shuffle and the join. Here the rows of a hot key
are spread over several partitions by a salt, and the single matching row of the other side is
copied to each of them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DataType, IntegerType, MapType, ShortType, StringType, StructType, VariantType

SALT = "_salt"
_HASH = "_key_hash"

# A key is hot from this share of all rows on, so there are at most 1/share hot keys.
HOT_SHARE = 1 / 10_000
# Below this many rows a key fits in one task whatever its share.
HOT_ROWS = 5_000_000
# First-level sketches, so that no single task merges one sketch per input task.
_SKETCH_GROUPS = 256


@dataclass(frozen=True)
class HotKeys:
    """Hash of each hot key and the number of partitions its rows are spread over."""

    keys: tuple[str, ...]
    salts: Mapping[int, int]

    def __bool__(self) -> bool:
        return bool(self.salts)


def same_key_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their keys in the common type, as a plain join would compare them.

    Hashes depend on the type, so keys that are equal but of two types would be salted differently.
    Text against anything else is refused: which side is to be cast is for the caller to say.
    """
    for key in keys:
        one, other = left.schema[key].dataType, right.schema[key].dataType
        if one == other:
            continue
        if isinstance(one, StringType) != isinstance(other, StringType):
            raise ValueError(f"key {key} is {one.simpleString()} on one side and {other.simpleString()} on the other")
        common = left.select(key).union(right.select(key)).schema[key].dataType
        left, right = left.withColumn(key, F.col(key).cast(common)), right.withColumn(key, F.col(key).cast(common))
    return left, right


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Equal whole numbers have one hash, whatever their type."""
    whole = (ByteType, ShortType, IntegerType)
    return F.xxhash64(*[F.col(k).cast("bigint") if isinstance(df.schema[k].dataType, whole) else F.col(k) for k in keys])


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, min_rows: int = HOT_ROWS
) -> HotKeys:
    """Find the keys that hold at least ``share`` of the rows, and at least ``min_rows``.

    One pass over the key columns with a frequent-items sketch of fixed size. What reaches the
    driver is bounded by ``1 / share``. The answer only decides how rows are spread, never which
    rows are kept, so an estimate is enough.
    """
    top = math.ceil(1 / share)
    tracked = 10 * top
    groups = (
        df.select(_key_hash(df, keys).alias(_HASH), F.pmod(F.spark_partition_id(), F.lit(_SKETCH_GROUPS)).alias("g"))
        .groupBy("g")
        .agg(F.count("*").alias("n"), F.expr(f"approx_top_k_accumulate({_HASH}, {tracked})").alias("s"))
    )
    # Grouped by a constant: without input there is then no row, where a bare combine would fail.
    found = (
        groups.groupBy(F.lit("all"))
        .agg(
            F.sum("n").alias("n"),
            F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {top})").alias("top"),
        )
        .first()
    )
    if found is None:
        return HotKeys(tuple(keys), {})
    floor = max(share * found["n"], min_rows)
    per_task = max(1, min_rows // 5)
    salts = {i["item"]: math.ceil(i["count"] / per_task) for i in found["top"] if i["count"] >= floor}
    return HotKeys(tuple(keys), salts)


def _salt_counts(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Attach the number of salts of each row's key; the broadcast table has at most 1/share rows."""
    table = df.sparkSession.createDataFrame(list(hot.salts.items()), f"{_HASH} bigint, _salts bigint")
    return (
        df.withColumn(_HASH, _key_hash(df, hot.keys))
        .join(F.broadcast(table), _HASH, "left")
        .withColumn("_salts", F.coalesce("_salts", F.lit(1)))
        .drop(_HASH)
    )


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def spread(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Salt the side that may hold many rows per key.

    The salt depends on the row and on the input task, so that identical copies are spread too, and
    it comes out the same when a lost task is run again.
    """
    content = [f.name for f in df.schema if _hashable(f.dataType)]
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *content), F.col("_salts"))
    return _salt_counts(df, hot).withColumn(SALT, salt).drop("_salts")


def replicate(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Copy each row of the one-row-per-key side to every salt of its key."""
    salts = F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1)
    return _salt_counts(df, hot).withColumn(SALT, F.explode(salts)).drop("_salts")


def join_to_unique(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, hot: HotKeys | None = None
) -> DataFrame:
    """Join ``left`` to ``right``, which holds one row per key.

    ``how`` is one of inner, left, left_semi and left_anti. Null keys match nothing.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    left, right = same_key_types(left, right, keys)
    if not hot:
        return left.join(right, list(keys), how)
    return spread(left, hot).join(replicate(right, hot), [*keys, SALT], how).drop(SALT)
