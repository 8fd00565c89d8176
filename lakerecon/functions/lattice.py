"""The least schema that can read every version of a feed.

Types form a lattice. Its bottom is null; whole numbers widen to longer ones, to decimals and to doubles, dates to timestamps,
and text holds every scalar. Structs are joined field by field, arrays and maps by what they hold. What has no common type,
such as a struct and a number, is a conflict: it is read as text, which for JSON is the value as it was written.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

# Whole numbers in widening order, with the digits that they need as decimals.
_WHOLE = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 20}
_NESTED = (StructType, ArrayType, MapType, VariantType)
_MAX_DIGITS = 38


@dataclass(frozen=True)
class Join:
    """The least type above some types, and the paths at which they conflict."""

    type: DataType
    conflicts: tuple[str, ...] = ()


def _decimal(kind: DataType) -> DecimalType | None:
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(_WHOLE[kind], 0) if kind in _WHOLE else None


def _numbers(a: DataType, b: DataType) -> DataType | None:
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.get)
    one, other = _decimal(a), _decimal(b)
    if one and other:
        scale = max(one.scale, other.scale)
        digits = scale + max(one.precision - one.scale, other.precision - other.scale)
        return DecimalType(digits, scale) if digits <= _MAX_DIGITS else DoubleType()
    floating = (FloatType, DoubleType)
    if (one or isinstance(a, floating)) and (other or isinstance(b, floating)):
        return DoubleType()  # a float holds no longer whole numbers
    return None


def join_types(a: DataType, b: DataType, path: str = "") -> Join:
    """The least type that holds values of both; order does not matter, and joining again changes nothing."""
    if a == b or isinstance(b, NullType):
        return Join(a)
    if isinstance(a, NullType):
        return Join(b)
    if isinstance(a, StructType) and isinstance(b, StructType):
        return _structs(a, b, path)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = join_types(a.elementType, b.elementType, f"{path}[]")
        return Join(ArrayType(inner.type, a.containsNull or b.containsNull), inner.conflicts)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = join_types(a.keyType, b.keyType, f"{path}.key"), join_types(a.valueType, b.valueType, f"{path}.value")
        return Join(MapType(key.type, value.type, a.valueContainsNull or b.valueContainsNull), key.conflicts + value.conflicts)
    if isinstance(a, _NESTED) or isinstance(b, _NESTED):
        return Join(StringType(), (path,))
    if number := _numbers(a, b):
        return Join(number)
    for later in (TimestampType(), TimestampNTZType()):
        if {a, b} == {DateType(), later}:
            return Join(later)
    return Join(StringType())


def _structs(a: StructType, b: StructType, path: str) -> Join:
    """Fields in the order of their names, so that the result does not depend on which version came first."""
    fields, conflicts = [], ()
    sides = [{f.name: f for f in side} for side in (a, b)]
    for name in sorted({*sides[0], *sides[1]}):
        one, other = (side.get(name, StructField(name, NullType())) for side in sides)
        joined = join_types(one.dataType, other.dataType, f"{path}.{name}" if path else name)
        fields.append(StructField(name, joined.type, one.nullable or other.nullable))
        conflicts += joined.conflicts
    return Join(StructType(fields), conflicts)


def _conflicted(kind: DataType, path: str = "") -> Iterable[str]:
    """Paths of one version that no type fits; text stands for them."""
    if isinstance(kind, VariantType):
        yield path
    elif isinstance(kind, StructType):
        for f in kind:
            yield from _conflicted(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, ArrayType):
        yield from _conflicted(kind.elementType, f"{path}[]")
    elif isinstance(kind, MapType):
        yield from _conflicted(kind.valueType, f"{path}.value")


def _readable(kind: DataType) -> DataType:
    """With text for what has no type yet or none at all, and with nulls allowed everywhere."""
    if isinstance(kind, (NullType, VariantType)):
        return StringType()
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _readable(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_readable(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(_readable(kind.keyType), _readable(kind.valueType))
    return kind


def reader_lattice(versions: Iterable[StructType]) -> Join:
    """The schema that reads all versions, all of it nullable, and the paths that had to become text because types conflict."""
    versions = list(versions)

    def add(seen: Join, version: StructType) -> Join:
        joined = join_types(seen.type, version)
        return Join(joined.type, seen.conflicts + joined.conflicts)

    found = reduce(add, versions, Join(StructType([])))
    paths = {*found.conflicts, *(p for v in versions for p in _conflicted(v))}
    # below a conflict everything is text already
    kept = sorted(p for p in paths if not any(p != q and (p.startswith(f"{q}.") or p.startswith(f"{q}[]")) for q in paths))
    return Join(_readable(found.type), tuple(kept))
