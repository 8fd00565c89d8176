"""Schemas given as StructType, as its JSON text, or as DDL."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType, TimestampNTZType, TimestampType


def as_struct(schema: StructType | str) -> StructType:
    """Accept a StructType, a JSON-serialised one, or a DDL string."""
    if isinstance(schema, StructType):
        return schema
    if schema.lstrip().startswith("{"):
        return StructType.fromJson(json.loads(schema))
    return StructType.fromDDL(schema)


def as_nullable(kind: DataType) -> DataType:
    """The same type with every field, element and value nullable."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, as_nullable(f.dataType), True, f.metadata) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(as_nullable(kind.elementType), True)
    if isinstance(kind, MapType):
        return MapType(as_nullable(kind.keyType), as_nullable(kind.valueType), True)
    return kind


def wall_clock(moment: datetime, kind: DataType = TimestampType()) -> Column:
    """A literal showing ``moment`` in the session's time zone, whatever the zone of this process."""
    return F.lit(moment.isoformat(" ")).cast(kind)


def typed_literal(value: object, kind: DataType) -> Column:
    """A value read from a column of type ``kind`` as a literal of that type."""
    if isinstance(kind, TimestampNTZType) and isinstance(value, datetime):
        return wall_clock(value, kind)
    return F.lit(value).cast(kind)
