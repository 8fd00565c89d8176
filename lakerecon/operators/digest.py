"""Comparison by digests: rows that agree are hashed where they lie and never shuffled.

The rows of a side are dealt to leaves by a hash of their key. A leaf's digest is the number of its rows, sums of their hashes
and the exclusive or of other hashes of them, so it does not depend on their order and is combined before the shuffle. Leaves
are children of buckets, buckets of the root; a node's digest follows from its children's. Two sides hold the same rows in a
leaf if the digests agree, but for a chance of about 2^-128.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StructType, VariantType

from ..session import materialise
from .compare import AUTO, compare_rows
from .hotkeys import HotKeys, same_key_types

#: Buckets of a table, and leaves of a bucket. The leaves that differ are broadcast: 16 bytes each, 16 MiB if all do.
BUCKETS = 4096
LEAVES = 256

#: The bucket of rows with a null in their key. They match nothing, so it is never taken for equal.
UNKEYED = -1

BUCKET, LEAF = "key_bucket", "key_leaf"
DIGEST = ["n", "high", "low", "mixed"]


def _hashed(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashed(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _hashed(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def _content(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns and which of them are null, which a hash alone would leave out."""
    bad = [c for c in columns if not _hashed(df.schema[c].dataType)]
    if bad:
        raise ValueError(f"maps and variants have no digest: {bad}")
    nested = [F.to_json(F.col(c), {"ignoreNullFields": "false"}) for c in columns if isinstance(df.schema[c].dataType, (ArrayType, StructType))]
    nulls = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    return [*(F.col(c) for c in columns), nulls, *nested]


def with_leaf(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, leaves: int = LEAVES) -> DataFrame:
    """Adds ``key_bucket`` and ``key_leaf``; both follow from the key alone."""
    if {BUCKET, LEAF} & set(df.columns):
        raise ValueError(f"{BUCKET} and {LEAF} are taken")
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    # a hash of its own: the bucket has used up bits of the first
    leaf = F.pmod(F.xxhash64(F.lit(LEAF), *keys), F.lit(leaves))
    return df.withColumns({BUCKET: F.when(null, UNKEYED).otherwise(bucket).cast("int"), LEAF: F.when(null, 0).otherwise(leaf).cast("int")})


def leaf_digests(leafed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per bucket and leaf that has rows; ``columns`` are those that have to agree, keys included."""
    content = _content(leafed, columns)
    low_half = F.lit(0xFFFFFFFF).cast("long")
    rows = leafed.select(BUCKET, LEAF, F.xxhash64(*content).alias("h"), F.xxhash64(F.lit("other"), *content).alias("mixed"))
    # half a hash at a time: sums of 2^31 rows fit
    return rows.groupBy(BUCKET, LEAF).agg(
        F.count("*").alias("n"),
        F.sum(F.shiftrightunsigned("h", 32)).alias("high"),
        F.sum(F.col("h").bitwiseAND(low_half)).alias("low"),
        F.bit_xor("mixed").alias("mixed"),
    )


def parent_digests(digests: DataFrame, by: Sequence[str]) -> DataFrame:
    """The digests of the nodes above, ``by`` bucket or, with nothing, of the root."""
    sums = [F.sum(c).alias(c) for c in ("n", "high", "low")]
    return digests.groupBy(*by).agg(*sums, F.bit_xor("mixed").alias("mixed"))


def _unlike(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Nodes that only one side has or whose digests differ."""
    mine = left.select(*by, F.struct(*DIGEST).alias("l"))
    other = right.select(*by, F.struct(*DIGEST).alias("r"))
    return mine.join(other, list(by), "full_outer").filter(~F.col("l").eqNullSafe(F.col("r")) | (F.col(BUCKET) == UNKEYED))


def differing_buckets(left: DataFrame, right: DataFrame) -> list[int]:
    """Buckets that differ, from the leaf digests of both sides; at most as many as there are buckets."""
    unlike = _unlike(parent_digests(left, [BUCKET]), parent_digests(right, [BUCKET]), [BUCKET])
    return sorted(r[0] for r in unlike.select(BUCKET).collect())


def differing_leaves(left: DataFrame, right: DataFrame, buckets: Sequence[int]) -> DataFrame:
    """Leaves that differ in ``buckets``, with the rows that each side has there."""
    inside = F.col(BUCKET).isin(list(buckets))
    unlike = _unlike(left.filter(inside), right.filter(inside), [BUCKET, LEAF])
    return unlike.select(BUCKET, LEAF, F.coalesce("l.n", F.lit(0)).alias("left_rows"), F.coalesce("r.n", F.lit(0)).alias("right_rows"))


def same_types(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``keys`` and ``columns`` alone, in types whose equal values hash alike.

    Numbers of two types meet in their common type, as a comparison of the two would have them. Other columns keep
    their types; where these differ, all their leaves do, and the comparison itself decides.
    """
    names = list(dict.fromkeys([*keys, *columns]))
    left, right = same_key_types(left.select(*names), right.select(*names), keys)
    for name in names:
        one, other = left.schema[name].dataType, right.schema[name].dataType
        if one != other and isinstance(one, NumericType) and isinstance(other, NumericType):
            common = left.select(name).union(right.select(name)).schema[name].dataType
            left, right = (side.withColumn(name, F.col(name).cast(common)) for side in (left, right))
    return left, right


@dataclass(frozen=True)
class DigestRecon:
    """What two sides differ in. ``counts`` cover all rows; ``exceptions`` has those of ``compare_rows`` that are not equal."""

    counts: dict[str, int]
    buckets: tuple[int, ...]
    exceptions: DataFrame


def _total(digests: DataFrame) -> int:
    return digests.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def open_leaves(df: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows of these leaves, found by a broadcast of their numbers."""
    return df.join(F.broadcast(leaves.select(BUCKET, LEAF)), [BUCKET, LEAF], "left_semi").drop(BUCKET, LEAF)


def recon_leaves(
    source: DataFrame,
    target: DataFrame,
    source_digests: DataFrame,
    target_digests: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_safe: bool = True,
    hot: HotKeys | str | None = AUTO,
    buckets: Sequence[int] | None = None,
) -> DigestRecon:
    """Compare the rows of leaves whose digests differ; both sides have ``key_bucket`` and ``key_leaf``."""
    found = differing_buckets(source_digests, target_digests) if buckets is None else list(buckets)
    leaves = differing_leaves(source_digests, target_digests, found)
    inside = F.col(BUCKET).isin(found)
    compared = compare_rows(
        open_leaves(source.filter(inside), leaves), open_leaves(target.filter(inside), leaves), keys, columns, null_safe, hot
    )
    return DigestRecon(
        counts={"source_row_count": _total(source_digests), "target_row_count": _total(target_digests)},
        buckets=tuple(found),
        exceptions=compared.filter((F.col("present_in") != "both") | F.col("is_mismatch")),
    )


def recon_by_digest(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_safe: bool = True,
    hot: HotKeys | str | None = AUTO,
    buckets: int = BUCKETS,
    leaves: int = LEAVES,
) -> DigestRecon:
    """The exceptions of ``compare_rows(source, target, ...)`` without shuffling rows that agree.

    Each side is read twice, its digests first; rows of leaves that differ are then joined. As there, the source holds one
    row per key, and a null key matches nothing. Use it where few rows differ; tables that are compared again and again
    are better kept as ``BucketedTable``, which has the digests ready and reads buckets that differ only.
    """
    names = list(dict.fromkeys([*keys, *columns]))
    sides = [with_leaf(side, keys, buckets, leaves) for side in same_types(source, target, keys, columns)]
    digests = [materialise(leaf_digests(side, names), "digests") for side in sides]
    return recon_leaves(*sides, *digests, keys, columns, null_safe, hot)
