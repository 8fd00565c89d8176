"""Directories the layout and movement queries read: the events table as other systems land it."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakerecon import shared_dir, write_history, write_raw
from lakerecon.model import PARTITION_COLUMN
from lakerecon.sinks.files import MICROSECONDS

from .registry import once_per_application, table

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def dated(spark, sf):
    return table(spark, sf, "events").withColumn(PARTITION_COLUMN, F.to_date("ts"))


@once_per_application
def raw_events(spark, sf):
    """Gzip JSON in dated directories, several small files each."""
    path = shared_dir(spark, "raw")
    write_raw(dated(spark, sf).repartition(3), path, [PARTITION_COLUMN])
    return path


@once_per_application
def calendar_events(spark, sf):
    """JSON in yyyy/mm/dd directories, one write per day as a delivery service would do."""
    path = shared_dir(spark, "calendar")
    events = dated(spark, sf)
    for (day,) in sorted(events.select(PARTITION_COLUMN).distinct().collect()):
        one = events.filter(F.col(PARTITION_COLUMN) == day).drop(PARTITION_COLUMN)
        one.write.options(**MICROSECONDS).json(f"{path}/{day:%Y/%m/%d}")
    return path


@once_per_application
def payload_objects(spark, sf):
    """JSON lines whose PayLoad is an object, not text."""
    path = shared_dir(spark, "payload")
    table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("PolicyNumber"),
        F.struct("value", F.struct("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).alias("detail")).alias("PayLoad"),
    ).write.json(path)
    return path


# Errors arrive with their payload cut off at the closing brace; sign-ups of small value have none.
BROKEN = """
SELECT event_id, ts, user_id, event_type, value,
       CASE WHEN event_type = 'error' THEN replace(props, '}', '') WHEN event_type = 'signup' AND value < 5 THEN NULL ELSE props END AS payload
FROM events
"""


def broken_events(spark, sf):
    # The braces in the text rule out {name} formatting.
    events = table(spark, sf, "events")
    payload = F.when(F.col("event_type") == "error", F.replace("props", F.lit("}"), F.lit(""))).when(
        (F.col("event_type") == "signup") & (F.col("value") < 5), F.lit(None)
    ).otherwise(F.col("props"))
    return events.withColumn("payload", payload).drop("props")


@once_per_application
def broken_raw(spark, sf):
    path = shared_dir(spark, "broken")
    write_raw(broken_events(spark, sf).withColumn(PARTITION_COLUMN, F.to_date("ts")), path, [PARTITION_COLUMN])
    return path


def partial_history(spark, sf):
    """A history that stops in the morning of January 20th."""
    path = shared_dir(spark, "history")
    kept = dated(spark, sf).filter(F.col("ts") < F.lit("2024-01-20 06:00:00").cast("timestamp_ntz"))
    write_history(kept, path, [PARTITION_COLUMN])
    return path
