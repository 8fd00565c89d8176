"""Raw JSON to a relational table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..functions.payload import extract_keys
from ..model import LoadSpec
from ..operators.layout import cap_partitions
from ..sinks.jdbc import load_jdbc, verify_load
from ..sources.files import _no_data, has_rows, read_events
from .batch import run_sql_step


def load_frame(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The rows to load: declared schema, extracted keys, then the SQL over ``{input}``."""
    raw = read_events(spark, spec.path, schema=spec.schema)
    if spec.extract:
        raw = extract_keys(raw, spec.payload, spec.extract)
    out = run_sql_step(spark, spec.sql, spec.params, {"input": raw})
    return cap_partitions(out, spec.max_partitions)


def load_history(
    spark: SparkSession, spec: LoadSpec, url: str, properties: Mapping[str, str] | None = None, **options
) -> int:
    """Append to the table and return the rows it then holds; 0 when there was no input."""
    try:
        empty = not has_rows(read_events(spark, spec.path, schema=spec.schema))
    except AnalysisException as error:
        if not _no_data(error):
            raise
        empty = True
    if empty:
        return 0
    load_jdbc(load_frame(spark, spec), url, spec.table, properties=properties, **options)
    return verify_load(spark, url, spec.table, properties)
