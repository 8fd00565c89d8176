"""Whole-number keys as exact bitmaps: what is compared, counted and shuffled are 4 KiB for 32,768 neighbouring keys.

For keys that lie close together, such as those a sequence hands out. Far-apart keys have a bitmap each: ``bitmap_cost``
says beforehand how many bytes of bitmap stand for a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from ..session import materialise

#: Keys of a bitmap, and its bytes.
BITS = 32_768
BYTES = BITS // 8
#: Bitmaps of missing keys that are broadcast: 64 MiB.
MAX_BROADCAST = 16_384

BUCKET, BITMAP = "bucket", "bitmap"


def _whole(df: DataFrame, key: str) -> Column:
    if not isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise ValueError(f"{key} is no whole number: {df.schema[key].dataType.simpleString()}")
    return F.col(key).cast("long")


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """``bucket`` and ``bitmap`` of the keys, null keys left out; combined in each task before anything is shuffled."""
    whole = _whole(df, key)
    placed = df.filter(F.col(key).isNotNull()).select(F.bitmap_bucket_number(whole).alias(BUCKET), F.bitmap_bit_position(whole).alias("bit"))
    return placed.groupBy(BUCKET).agg(F.bitmap_construct_agg("bit").alias(BITMAP))


def merge_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One bitmap per bucket out of several, such as those kept per day."""
    return bitmaps.groupBy(BUCKET).agg(F.bitmap_or_agg(BITMAP).alias(BITMAP))


def count_keys(bitmaps: DataFrame) -> DataFrame:
    """The exact number of distinct keys, as one row with ``keys``."""
    return bitmaps.agg(F.coalesce(F.sum(F.bitmap_count(BITMAP)), F.lit(0)).alias("keys"))


def bitmap_cost(df: DataFrame, key: str) -> float:
    """Bytes of bitmap for each row with a key, about; below 16 or so bitmaps are smaller than the keys in a shuffle."""
    whole = _whole(df, key)
    buckets, rows = df.agg(F.approx_count_distinct(F.bitmap_bucket_number(whole)), F.count(whole)).first()
    return BYTES * buckets / rows if rows else 0.0


def missing_bitmaps(source: DataFrame, target: DataFrame) -> DataFrame:
    """``bucket``, both bitmaps (``mine``, ``other``; the latter null if there is none) and ``n_missing`` where source keys are missing.

    The union of both has as many keys as the target alone unless some are missing.
    """
    both = source.withColumnRenamed(BITMAP, "mine").join(target.withColumnRenamed(BITMAP, "other"), BUCKET, "left")
    union = F.bitmap_or_agg(BITMAP)
    sides = both.select(BUCKET, "mine", "other", F.explode(F.array_compact(F.array("mine", "other"))).alias(BITMAP))
    found = sides.groupBy(BUCKET).agg(F.any_value("mine").alias("mine"), F.any_value("other", True).alias("other"), F.bitmap_count(union).alias("all"))
    missing = F.col("all") - F.coalesce(F.bitmap_count("other"), F.lit(0))
    return found.withColumn("n_missing", missing).drop("all").filter("n_missing > 0")


def _byte(bitmap: str, at: Column) -> Column:
    """Byte number ``at``; a missing bitmap is empty."""
    return F.coalesce(F.conv(F.hex(F.substring(F.col(bitmap), at + 1, F.lit(1))), 16, 10).cast("int"), F.lit(0))


def _key_of(bit: Column) -> Column:
    """The key of a bit: buckets above 0 count up from their first key, the others down."""
    return F.when(F.col(BUCKET) > 0, (F.col(BUCKET) - 1) * BITS + bit + 1).otherwise(F.col(BUCKET) * BITS - bit)


def missing_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The distinct keys of the source that the target lacks, null aside: bits that only its bitmaps have."""
    found = missing_bitmaps(key_bitmaps(source, key), key_bitmaps(target, key))
    octets = found.select(BUCKET, "mine", "other", F.explode(F.sequence(F.lit(0), F.lit(BYTES - 1))).alias("at"))
    only = _byte("mine", F.col("at")).bitwiseAND(F.bitwise_not(_byte("other", F.col("at"))))
    octets = octets.select(BUCKET, "at", only.alias("only")).filter("only != 0")
    bits = octets.select(BUCKET, "at", "only", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")).filter("(only >> bit) & 1 = 1")
    return bits.select(_key_of((F.col("at") * 8 + F.col("bit")).cast("long")).cast(source.schema[key].dataType).alias(key))


def missing_records_bitmap(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source rows whose key the target lacks, as ``missing_records`` gives them; a null key is always missing.

    Bitmaps of the keys are shuffled, rows are not: each looks up its bit in the bitmaps of those buckets in which keys are
    missing. If these are more than MAX_BROADCAST (a row for each is counted first), the missing keys are joined instead.
    """
    found = missing_bitmaps(key_bitmaps(source, key), key_bitmaps(target, key))
    lost = materialise(found.select(F.col(BUCKET).alias("_bucket"), F.coalesce("other", F.lit(bytes(BYTES))).alias("_other")), "missing-bitmaps")
    if lost.limit(MAX_BROADCAST + 1).count() > MAX_BROADCAST:
        keyed = source.join(missing_keys(source, target, key), key, "left_semi")
        return keyed.unionByName(source.filter(F.col(key).isNull()))
    whole = _whole(source, key)
    placed = source.withColumns({"_bucket": F.bitmap_bucket_number(whole), "_bit": F.bitmap_bit_position(whole)})
    looked = placed.join(F.broadcast(lost), "_bucket", "left")
    there = F.expr("(conv(hex(substring(_other, cast(_bit div 8 as int) + 1, 1)), 16, 10) >> cast(_bit % 8 as int)) & 1")
    absent = F.col(key).isNull() | (F.col("_other").isNotNull() & (there == 0))
    return looked.filter(absent).drop("_bucket", "_bit", "_other").select(source.columns)
