"""Whole reconciliation runs, drill-down by counts, and what happens to hot, textual and null keys."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import functions as F

from lakerecon import (
    CompactionSpec,
    CountReconSpec,
    HighWater,
    IngestSpec,
    compact,
    drill_counts,
    find_hot_keys,
    ingest_history,
    missing_records,
    publish_count_control,
    read_events,
    recon_run,
    row_recon,
    shared_dir,
)
from lakerecon.model import PARTITION_COLUMN

from . import landing, pairs
from .registry import as_text, query, table
from .verification import EVENT_SPEC, STAMP

_WINDOW = pairs.CTES + """
, s AS (SELECT * FROM src WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'),
  t AS (SELECT * FROM tgt WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00')
"""
_MISMATCH = "s.user_id IS DISTINCT FROM t.user_id OR s.event_type IS DISTINCT FROM t.event_type OR s.amount IS DISTINCT FROM t.amount"


@query(_WINDOW + f"""
SELECT '2024-01-15' AS day, true AS ran, (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
       (SELECT count(*) FROM s ANTI JOIN t USING (event_id)) AS missing, (SELECT count(*) FROM s ANTI JOIN t USING (event_id)) AS exported,
       (SELECT count(*) FROM s JOIN t USING (event_id) WHERE {_MISMATCH}) AS mismatched
UNION ALL SELECT '2024-02-01', false, 0, 0, 0, 0, 0
UNION ALL SELECT '2031-01-01', false, 0, 0, 0, 0, 0
""", name="recon_run")
def recon_run_days(spark, sf):
    """From directories to exports, on a day that is there and on days that are not."""
    spec = replace(EVENT_SPEC, expressions={"amount": "CAST(value AS DECIMAL(12, 2))"})
    told = []
    for as_of in (pairs.AS_OF, datetime(2024, 2, 1), datetime(2031, 1, 1)):
        out = shared_dir(spark, "recon-run")
        done = recon_run(spark, landing.raw_events(spark, sf), pairs.target(spark, sf), spec, as_of, out, schema=landing.EVENT_SCHEMA)
        counts = done.published.counts if done.published else {}
        names = ("source_record_count", "target_row_count", "missing_record_count")
        numbers = [*(counts.get(n, 0) for n in names), done.exported, counts.get("mismatched_record_count", 0)]
        told.append((str(as_of.date()), done.published is not None, *numbers))
    columns = "source_rows bigint, target_rows bigint, missing bigint, exported bigint, mismatched bigint"
    return spark.createDataFrame(told, f"day string, ran boolean, {columns}")


_LINE_COUNTS = """
SELECT 'lines' AS ctrl_name, a.s AS status, a.c AS n, a.c - b.c AS differences, CASE WHEN a.c = b.c THEN 'success' ELSE 'Failure' END AS run_status
FROM (SELECT l_linestatus AS s, count(*) AS c FROM lineitem GROUP BY 1) a
JOIN (SELECT l_linestatus AS s, count(DISTINCT l_orderkey) AS c FROM lineitem GROUP BY 1) b USING (s)
"""


@query(f"""
WITH r AS ({_LINE_COUNTS})
SELECT 'audit' AS part, json_object('ctrl_name', ctrl_name, 'status', status, 'n', n, 'differences', differences, 'run_status', run_status, 'run_id', 'r1')::VARCHAR AS record FROM r
UNION ALL
SELECT 'alert', json_object('rule_name', ctrl_name, 'differences', differences, 'status', status, 'n', n, 'run_status', run_status,
  'job_run_time', '2024-01-15T17:00:00.123456Z', 'job_run_time_est', '2024-01-15T12:00:00.123456Z', 'content_type', 'reconciliation_data', 'run_id', 'r1')::VARCHAR FROM r
""")
def count_controls_audit(spark, sf):
    """A control whose audit fields go to a table and into its alerts."""
    path = shared_dir(spark, "control-audit")
    name = "control_" + path.rsplit("-", 1)[1]
    columns = "ctrl_name STRING, status STRING, n BIGINT, differences BIGINT, run_status STRING, run_time TIMESTAMP_NTZ, run_id STRING"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    spec = CountReconSpec(
        "lines",
        "lineitem",
        "SELECT l_linestatus AS grp, count(*) AS left_count FROM {lineitem} GROUP BY l_linestatus",
        "SELECT l_linestatus AS grp, count(DISTINCT l_orderkey) AS right_count FROM {lineitem} GROUP BY l_linestatus",
        ["grp"],
        audit_fields=["ctrl_name", "grp AS status", "left_count AS n", "differences", "run_status"],
    )
    alerts = publish_count_control(spark, spec, name, STAMP, {"lineitem": table(spark, sf, "lineitem")})
    spark.sql(f"DROP TABLE {name}")
    audit = spark.read.parquet(path).drop("run_time")
    return audit.select(F.lit("audit").alias("part"), F.to_json(F.struct(*audit.columns)).alias("record")).unionAll(
        alerts.select(F.lit("alert"), "alert")
    )


@query(pairs.CTES + """
, l AS (SELECT ts::DATE AS day, event_type, hour(ts) AS hour, count(*) AS n FROM src GROUP BY ALL),
  r AS (SELECT ts::DATE AS day, event_type, hour(ts) AS hour, count(*) AS n FROM tgt GROUP BY ALL),
  b AS (SELECT coalesce(l.day, r.day) AS day, coalesce(l.event_type, r.event_type) AS event_type, coalesce(l.hour, r.hour) AS hour,
               coalesce(l.n, 0) AS a, coalesce(r.n, 0) AS c FROM l FULL JOIN r ON l.day = r.day AND l.event_type = r.event_type AND l.hour = r.hour),
  l0 AS (SELECT 0 AS level, NULL::DATE AS day, NULL::VARCHAR AS event_type, NULL::BIGINT AS hour, sum(a) AS a, sum(c) AS c FROM b),
  l1 AS (SELECT 1 AS level, day, NULL::VARCHAR AS event_type, NULL::BIGINT AS hour, sum(a) AS a, sum(c) AS c FROM b GROUP BY day),
  l2 AS (SELECT 2 AS level, day, event_type, NULL::BIGINT AS hour, sum(a) AS a, sum(c) AS c FROM b WHERE day IN (SELECT day FROM l1 WHERE a <> c) GROUP BY day, event_type),
  l3 AS (SELECT 3 AS level, day, event_type, hour, a, c FROM b WHERE (day, event_type) IN (SELECT (day, event_type) FROM l2 WHERE a <> c)),
  x AS (FROM l0 UNION ALL FROM l1 UNION ALL FROM l2 UNION ALL FROM l3)
SELECT level, strftime(day, '%Y-%m-%d') AS day, event_type, CAST(hour AS VARCHAR) AS hour, CAST(a AS BIGINT) AS left_count, CAST(c AS BIGINT) AS right_count,
       CAST(a - c AS BIGINT) AS differences, CASE WHEN a = c THEN 'success' ELSE 'Failure' END AS run_status,
       CASE WHEN a > 0 AND c > 0 THEN 'both' WHEN a > 0 THEN 'left' ELSE 'right' END AS present_in, 'events' AS ctrl_name, 'served_events' AS table_name
FROM x
""")
def count_recon_drill(spark, sf):
    """From the total by day and type to the hour, opening only what differs."""
    def dated(df):
        return df.withColumns({"day": F.to_date("ts"), "hour": F.hour("ts")})

    found = drill_counts(dated(pairs.source(spark, sf)), dated(pairs.target(spark, sf)), ["day", "event_type", "hour"], "events", "served_events")
    return as_text(found, "day", "hour")


@query("""
SELECT * FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT l_returnflag AS f, l_linestatus AS s FROM lineitem WHERE l_returnflag <> 'N') x
  WHERE x.f = l_returnflag AND x.s = l_linestatus)
""")
def missing_records_hot(spark, sf):
    """Four keys for all rows, each of them hot: rows are spread over salts, none is lost or doubled."""
    lines, keys = table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]
    hot = find_hot_keys(lines, keys, min_rows=1000)
    if not hot:
        raise ValueError("keys with a large share of the rows must be found")
    return missing_records(lines, lines.filter("l_returnflag <> 'N'"), keys, hot=hot)


@query(_WINDOW + f"""
SELECT 'served_events' AS table_name, (SELECT count(*) FROM s) AS source_record_count, (SELECT count(*) FROM s) AS source_row_count,
       (SELECT count(*) FROM t) AS target_row_count, (SELECT count(*) FROM s) - (SELECT count(*) FROM t) AS difference_total_row_count,
       5 AS source_column_count, 5 AS target_column_count, 0 AS difference_total_column_count,
       (SELECT count(*) FROM s WHERE event_type = 'error' OR event_id NOT IN (SELECT event_id FROM t)) AS missing_record_count,
       (SELECT count(*) FROM s JOIN t USING (event_id) WHERE s.event_type <> 'error' AND ({_MISMATCH})) AS mismatched_record_count
""")
def recon_summary_text_keys(spark, sf):
    """Keys that arrive as text; those of errors are no numbers, so each such record is missing in the target."""
    key = F.when(F.col("event_type") == "error", F.concat(F.lit("e-"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string"))
    source = pairs.source(spark, sf).withColumn("event_id", key)
    return row_recon(source, pairs.target(spark, sf), EVENT_SPEC, pairs.AS_OF).summary


@query(f"""
WITH b AS ({landing.BROKEN}), p AS (SELECT event_id % 10 = 0 AS unkeyed, ts < TIMESTAMP '2024-01-20' AS early, coalesce(json_valid(payload), false) AS ok FROM b)
SELECT 'first' AS run, count(*) FILTER (WHERE early) AS read, count(*) FILTER (WHERE early AND ok) AS written,
       count(*) FILTER (WHERE early AND NOT ok) AS quarantined, 0 AS unkeyed FROM p
UNION ALL
SELECT 'second', count(*) FILTER (WHERE NOT early AND NOT unkeyed), count(*) FILTER (WHERE NOT early AND NOT unkeyed AND ok),
       count(*) FILTER (WHERE NOT early AND NOT unkeyed AND NOT ok), count(*) FILTER (WHERE unkeyed) FROM p
UNION ALL
SELECT 'landed', count(*) FILTER (WHERE ok AND (early OR NOT unkeyed)), 0, 0, 0 FROM p
""")
def ingest_null_keys(spark, sf):
    """The counts of two runs over a feed with null bookmark keys, and what is landed afterwards."""
    root = shared_dir(spark, "null-keys")
    events = landing.broken_events(spark, sf)
    events = events.withColumn("event_id", F.when(F.col("event_id") % 10 != 0, F.col("event_id")))
    early = events.filter(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    spec = IngestSpec(
        job="events", payload="payload", payload_schema="k BIGINT", bookmark_keys=["ts", "event_id"],
        out=f"{root}/raw", quarantine=f"{root}/error", files=4,
    )
    marks, told = HighWater(spark, f"{root}/marks", spec.job), []
    for name, feed, day in (("first", early, date(2024, 2, 1)), ("second", events, date(2024, 2, 2))):
        done = ingest_history(feed, spec, marks, day)
        told.append((name, done.read, done.written, done.quarantined, done.unkeyed))
    landed = read_events(spark, spec.out, schema=f"k BIGINT, {PARTITION_COLUMN} DATE").count()
    told.append(("landed", landed, 0, 0, 0))
    return spark.createDataFrame(told, "run string, read bigint, written bigint, quarantined bigint, unkeyed bigint")


@query(f"""
SELECT event_id, ts, CASE WHEN event_id % 2 = 0 THEN user_id END AS user_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type,
       strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN} FROM events
""")
def compact_mixed_schemas(spark, sf):
    """Files of a day in two schemas: both columns survive, each null where its file has none."""
    root = shared_dir(spark, "mixed")
    events = landing.dated(spark, sf)
    for rest, column in ((0, "user_id"), (1, "event_type")):
        part = events.filter(F.col("event_id") % 2 == rest).select("event_id", "ts", column, PARTITION_COLUMN)
        part.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(f"{root}/in")
    compact(spark, f"{root}/in", f"{root}/out", CompactionSpec(source_format="parquet"))
    out = spark.read.parquet(f"{root}/out").select("event_id", "ts", "user_id", "event_type", PARTITION_COLUMN)
    return as_text(out, PARTITION_COLUMN)
