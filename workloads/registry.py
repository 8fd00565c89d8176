"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, or under ``name``."""

    def add(function: Query) -> Query:
        key = name or function.__name__
        _QUERIES[key] = function
        if oracle:
            _ORACLES[key] = oracle
        return function

    return add


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be null as text, because the engines hand them out differently."""
    return df.withColumns({c: df[c].cast("string") for c in columns})


def once_per_application(build):
    """Directories that queries only read are written once per application and input."""
    made: dict[tuple[str, str], str] = {}

    @wraps(build)
    def get(spark: SparkSession, sf: str) -> str:
        key = (spark.sparkContext.applicationId, sf)
        if key not in made:
            made[key] = build(spark, sf)
        return made[key]

    return get
