"""Relational scans. One connection per Spark partition; filters and columns are pushed by Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows per round trip; drivers that default to "all rows" would otherwise fill the executor.
FETCH_SIZE = "10000"


def _relation(table_or_query: str) -> str:
    text = table_or_query.strip().rstrip(";")
    return f"({text}) tmp" if text.lower().startswith(("select", "with")) else text


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: Mapping[str, str] | None = None,
    bounds: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """Scan a table or query; ``bounds = (column, low, high, partitions)`` reads ranges in parallel."""
    options = {"fetchsize": FETCH_SIZE, **(properties or {})}
    if bounds is None:
        return spark.read.jdbc(url, _relation(table_or_query), properties=options)
    column, low, high, count = bounds
    return spark.read.jdbc(
        url, _relation(table_or_query), column=column, lowerBound=low, upperBound=high,
        numPartitions=count, properties=options,
    )


def hash_predicates(field: str, n: int, hash_sql: str = "{field}") -> list[str]:
    """``n`` conditions that put every row, null keys included, in exactly one slice.

    ``hash_sql`` turns the field into an integer in the database's own dialect; the default suits
    integer fields. Negative remainders share the slice of their absolute value.
    """
    if n < 1:
        raise ValueError("at least one partition is needed")
    value = f"MOD({hash_sql.format(field=field)}, {n})"
    first = f"{value} = 0 OR {field} IS NULL"
    return [first, *[f"{value} IN ({i}, -{i})" for i in range(1, n)]]


def read_jdbc_hashed(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    field: str,
    n: int,
    properties: Mapping[str, str] | None = None,
    hash_sql: str = "{field}",
) -> DataFrame:
    """Scan in ``n`` parallel slices by the hash of ``field``."""
    options = {"fetchsize": FETCH_SIZE, **(properties or {})}
    predicates = hash_predicates(field, n, hash_sql)
    return spark.read.jdbc(url, _relation(table_or_query), predicates=predicates, properties=options)
