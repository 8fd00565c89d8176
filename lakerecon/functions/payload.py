"""JSON payload columns: key extraction, unboxing, splitting off rows that do not parse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import as_struct

CORRUPT = "_corrupt_record"
PAYLOAD = "_payload"


def extract_keys(df: DataFrame, column: str, paths: Mapping[str, str]) -> DataFrame:
    """Add one text column per JSON path: ``{path: alias}``."""
    return df.withColumns({alias: F.get_json_object(column, path) for path, alias in paths.items()})


def unbox(df: DataFrame, column: str, schema: StructType | str, into: str = PAYLOAD) -> DataFrame:
    """Parse a JSON text column into the struct ``into``.

    Text that does not fit the schema is kept in ``into._corrupt_record``.
    """
    fields = as_struct(schema)
    wide = StructType([*fields.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return df.withColumn(into, F.from_json(F.col(column), wide, options))


def is_bad(payload: str = PAYLOAD) -> Column:
    """True for rows whose payload was missing or did not parse."""
    return F.col(payload).isNull() | F.col(f"{payload}.{CORRUPT}").isNotNull()


def split_payload(df: DataFrame, column: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows to quarantine): every input row is in exactly one of them."""
    parsed = unbox(df, column, schema)
    good = parsed.filter(~is_bad())
    bad = quarantine_rows(parsed, column)
    return good, bad


def quarantine_rows(parsed: DataFrame, column: str) -> DataFrame:
    """The rows that failed, as they came in, with the reason."""
    reason = F.when(F.col(column).isNull(), "payload is null").otherwise("payload does not match the schema")
    return parsed.filter(is_bad()).withColumn("error", reason).drop(PAYLOAD)


def flatten_payload(df: DataFrame, payload: str = PAYLOAD, keep: Sequence[str] = (), **constants: object) -> DataFrame:
    """Replace each row by the fields of its payload, plus ``keep`` and constant columns."""
    names = [f.name for f in df.schema[payload].dataType.fields if f.name != CORRUPT]
    return df.select(
        *keep,
        *[F.col(payload).getField(n).alias(n) for n in names],
        *[F.lit(v).alias(k) for k, v in constants.items()],
    )


def rows_as_json(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """One JSON text per row; null fields are left out unless ``keep_nulls``."""
    options = {"ignoreNullFields": "false" if keep_nulls else "true"}
    return df.select(F.to_json(F.struct("*"), options).alias("json"))
