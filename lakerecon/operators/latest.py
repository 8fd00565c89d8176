"""Latest record per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind)
    return True


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key: the greatest by ``order``, then by ``tie_break``; nulls come last.

    ``tie_break`` defaults to all other columns that can be ordered, so the result does not depend
    on how the rows arrive. Spark keeps only the best row per key of each input task before the
    shuffle, so a key holding most of the rows costs one row per task.
    """
    if tie_break is None:
        used = {*keys, *order}
        tie_break = [f.name for f in df.schema if f.name not in used and _orderable(f.dataType)]
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*order, *tie_break]])
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
