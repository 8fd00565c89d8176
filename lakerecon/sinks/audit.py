"""Catalog sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import wall_clock
from ..functions.times import eastern_time
from ..model import AuditStamp


def audit_rows(df: DataFrame, stamp: AuditStamp) -> DataFrame:
    """Add the run id and the audit wall-clock time."""
    return df.withColumns(
        {"run_time": eastern_time(wall_clock(stamp.at)).cast("timestamp_ntz"), "run_id": F.lit(stamp.run_id)}
    )


def append_audit(df: DataFrame, table: str, stamp: AuditStamp) -> None:
    """Append stamped rows to an audit table, matching columns by name; the table is created if new."""
    audit_rows(df, stamp).write.mode("append").saveAsTable(table)


def repair_table(spark: SparkSession, table: str) -> None:
    """Register partitions that were written to the table's location."""
    spark.sql("MSCK REPAIR TABLE IDENTIFIER(:table)", args={"table": table})
