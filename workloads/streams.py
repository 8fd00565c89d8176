"""The streaming forms, run until they have read everything that is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakerecon import (
    CompactionSpec,
    compact_stream,
    corrected_stats_stream,
    ingest_stream,
    landing_stats_stream,
    read_corrected_stats,
    read_events,
    shared_dir,
    write_raw,
)
from lakerecon.model import PARTITION_COLUMN

from . import landing
from .layout import read_dated
from .registry import as_text, query


@query(f"""
WITH b AS ({landing.BROKEN})
SELECT event_id, json_extract_string(CASE WHEN json_valid(payload) THEN payload END, '$.k') AS k,
       strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN},
       CASE WHEN json_valid(payload) THEN 'landed' ELSE 'rejected' END AS place
FROM b
""")
def stream_ingest(spark, sf):
    root = shared_dir(spark, "stream")
    _ingest(spark, landing.broken_raw(spark, sf), root)
    return _places(spark, root)


def _ingest(spark, source, root, **more):
    ingest_stream(
        spark,
        source=source,
        schema=f"event_id BIGINT, payload STRING, {PARTITION_COLUMN} DATE",
        payload="payload",
        payload_schema="k BIGINT",
        out=f"{root}/raw",
        quarantine=f"{root}/error",
        checkpoint=f"{root}/checkpoint",
        by=[PARTITION_COLUMN],
        feed="events",
        keep=["event_id", PARTITION_COLUMN],
        **more,
    ).awaitTermination()


def _places(spark, root):
    schema = f"event_id BIGINT, k BIGINT, {PARTITION_COLUMN} DATE"
    landed = read_events(spark, f"{root}/raw", schema=schema).withColumn("place", F.lit("landed"))
    rejected = read_events(spark, f"{root}/error", schema=schema).withColumn("place", F.lit("rejected"))
    out = landed.select("event_id", "k", PARTITION_COLUMN, "place").unionByName(
        rejected.select("event_id", "k", PARTITION_COLUMN, "place")
    )
    return as_text(out, "k", PARTITION_COLUMN)


@query(f"""
WITH b AS ({landing.BROKEN})
SELECT event_id, json_extract_string(CASE WHEN json_valid(payload) THEN payload END, '$.k') AS k,
       strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN},
       CASE WHEN json_valid(payload) THEN 'landed' ELSE 'rejected' END AS place
FROM b
""")
def stream_ingest_unique(spark, sf):
    """Two starts, the second of which finds two thirds of the events delivered again: each is landed or rejected once."""
    root = shared_dir(spark, "stream-unique")
    events = landing.broken_events(spark, sf).withColumn(PARTITION_COLUMN, F.to_date("ts"))
    third = F.pmod("event_id", F.lit(3))
    for delivered in (events.filter(third != 0), events.filter(third != 2)):
        write_raw(delivered, f"{root}/in", [PARTITION_COLUMN])
        _ingest(spark, f"{root}/in", root, unique=["event_id"])
    return _places(spark, root)


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS rows FROM events GROUP BY ALL")
def stream_stats_late(spark, sf):
    """Three starts, each with days before those of the one before it: late rows correct windows that were counted."""
    root = shared_dir(spark, "stats-late")
    events = landing.dated(spark, sf)
    early, whole = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"), F.pmod("event_id", F.lit(5)) != 0
    for late in (events.filter(~early & whole), events.filter(early), events.filter(~early & ~whole)):
        write_raw(late, f"{root}/in", [PARTITION_COLUMN])
        stream = spark.readStream.schema(landing.EVENT_SCHEMA).option("maxFilesPerTrigger", 20).json(f"{root}/in")
        corrected_stats_stream(stream, "ts", ["event_type"], f"{root}/out", f"{root}/checkpoint", fold_every=2).awaitTermination()
    out = read_corrected_stats(spark, f"{root}/out")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(f"SELECT *, strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN} FROM events")
def stream_compact(spark, sf):
    root = shared_dir(spark, "stream-compact")
    compact_stream(
        spark,
        landing.raw_events(spark, sf),
        f"{root}/history",
        CompactionSpec(schema=landing.EVENT_SCHEMA),
        f"{root}/checkpoint",
    ).awaitTermination()
    return read_dated(spark, f"{root}/history")


@query("""
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS rows FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
GROUP BY ALL
""")
def stream_stats(spark, sf):
    root = shared_dir(spark, "stream-stats")
    events = spark.readStream.schema(landing.EVENT_SCHEMA).json(landing.raw_events(spark, sf))
    (
        landing_stats_stream(events, "ts", ["event_type"])
        .writeStream.format("parquet")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    out = spark.read.parquet(f"{root}/out")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
