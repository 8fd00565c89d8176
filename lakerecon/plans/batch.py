"""Configured SQL steps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..model import BatchSpec
from ..operators.stats import counted
from ..sinks.audit import repair_table


def run_sql_step(
    spark: SparkSession,
    sql: str,
    params: Mapping[str, object] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run SQL text as given; ``:name`` takes a value, ``{name}`` a frame.

    A database name is a value too: ``IDENTIFIER(:db || '.orders')``.
    """
    return spark.sql(sql, args=dict(params or {}), **(views or {}))


def run_batch(spark: SparkSession, spec: BatchSpec, views: Mapping[str, DataFrame] | None = None) -> int | None:
    """Register partitions, run the query, write its result; returns the rows the query gave.

    The rows are counted while they are written. Without ``write_sql`` the query is only run.
    """
    for table in spec.repair:
        repair_table(spark, table)
    output = run_sql_step(spark, spec.batch_sql, spec.params, views)
    if spec.write_sql is None:
        return output.count()
    output, seen = counted(output)
    output.createOrReplaceTempView(spec.output)
    spark.sql(spec.write_sql, args=dict(spec.params))
    return seen.get["rows"]
