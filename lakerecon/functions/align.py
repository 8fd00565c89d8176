"""Bring two frames to the same names, types and time window before they are compared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

from .schemas import wall_clock


def align_names(df: DataFrame, keys: Sequence[str], source: Sequence[str], target: Sequence[str]) -> DataFrame:
    """Keep the keys and rename ``target[i]`` to ``source[i]``."""
    if len(source) != len(target):
        raise ValueError("source and target names must pair up")
    return df.select(*keys, *[F.col(t).alias(s) for s, t in zip(source, target)])


def project_exprs(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], expressions: Mapping[str, str] | None = None
) -> DataFrame:
    """Keys then fields, in the given order; a name with an expression is computed from it.

    Expressions for names in neither list are appended, also in order.
    """
    expressions = expressions or {}
    names = list(dict.fromkeys([*keys, *fields, *expressions]))
    return df.select(*[F.expr(expressions[n]).alias(n) if n in expressions else F.col(n) for n in names])


def tag(df: DataFrame, **constants: object) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def within_window(df: DataFrame, column: str, as_of: datetime, hours: int = 24) -> DataFrame:
    """Rows of the half-open window ``[as_of - hours, as_of)``.

    ``as_of`` is read on the session's clock. For a timestamp column the bounds are literals of the
    column's own type, so that the comparison reaches the scan. Text columns are parsed first.
    """
    kind = df.schema[column].dataType
    value = as_local_timestamp(F.col(column), kind)
    bound_type = kind if isinstance(kind, (TimestampType, TimestampNTZType)) else TimestampNTZType()
    low, high = (wall_clock(t, bound_type) for t in (as_of - timedelta(hours=hours), as_of))
    return df.filter((value >= low) & (value < high))


def as_local_timestamp(column: Column, kind: DataType) -> Column:
    """A comparable timestamp from text (``T`` or blank between date and time) or from a timestamp."""
    if isinstance(kind, StringType):
        return column.try_cast("timestamp").cast("timestamp_ntz")
    return column


def align_types(
    df: DataFrame, reference: DataFrame, columns: Sequence[str], lost: str | None = None
) -> DataFrame:
    """Cast ``columns`` to the types they have in ``reference``; values that do not fit become null.

    ``lost`` names an extra column counting the values of the row that became null this way.
    """
    wanted = {c: reference.schema[c].dataType for c in columns}
    changed = {
        c: t for c, t in wanted.items() if df.schema[c].dataType.simpleString() != t.simpleString()
    }
    casts = {c: F.col(c).try_cast(t) for c, t in changed.items()}
    out = df
    if lost:
        failures = [
            (F.col(c).isNotNull() & cast.isNull()).cast("int") for c, cast in casts.items()
        ]
        out = out.withColumn(lost, reduce(lambda a, b: a + b, failures, F.lit(0)))
    return out.withColumns(casts) if casts else out


def misfit(df: DataFrame, reference: DataFrame, columns: Sequence[str]) -> Column:
    """True for rows of ``df`` with a value in ``columns`` that has no equal in the type of ``reference``."""
    lost = F.lit(False)
    for c in columns:
        if df.schema[c].dataType.simpleString() != reference.schema[c].dataType.simpleString():
            lost = lost | (F.col(c).isNotNull() & F.col(c).try_cast(reference.schema[c].dataType).isNull())
    return lost


def normalise_ts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make ``columns`` zoneless timestamps, so ``03.12`` and ``03.120`` are the same moment."""
    return df.withColumns(
        {c: as_local_timestamp(F.col(c), df.schema[c].dataType).cast("timestamp_ntz") for c in columns}
    )


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """Cast columns called ``timestamp``, in any case, to text."""
    named = [c for c in df.columns if c.upper() == "TIMESTAMP"]
    return df.withColumns({c: F.col(c).cast("string") for c in named}) if named else df


def redact(df: DataFrame, column: str, literals: Sequence[str], mask: str = "***") -> DataFrame:
    """Replace every occurrence of each literal, in the given order, by ``mask``."""
    masked = F.col(column)
    for literal in literals:
        if literal:
            masked = F.replace(masked, F.lit(literal), F.lit(mask))
    return df.withColumn(column, masked)
