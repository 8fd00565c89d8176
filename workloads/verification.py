"""Reconciliation, quality, statistics and alignment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from lakerecon import (
    AuditStamp,
    CountReconSpec,
    DQRule,
    OrphanRule,
    ReconSpec,
    RowRule,
    UniqueRule,
    align_names,
    align_types,
    append_audit,
    column_diff,
    compare_rows,
    count_recon,
    counted,
    diff_text,
    distinct_keys,
    export_missing,
    failed_groups,
    landing_stats,
    latest_per_key,
    missing_records,
    normalise_ts,
    project_exprs,
    publish_recon,
    recon_alerts,
    redact,
    row_recon,
    rule_summary,
    run_count_controls,
    run_fused,
    run_rules,
    shared_dir,
    tag,
)

from . import pairs
from .registry import as_text, query, table

STAMP = AuditStamp("r1", datetime(2024, 1, 15, 17, 0, 0, 123456))

EVENT_SPEC = ReconSpec(
    table="served_events",
    keys=["event_id"],
    source_fields=["ts", "user_id", "event_type", "amount"],
    target_fields=["ts", "user_id", "event_type", "amount"],
    compare=["user_id", "event_type", "amount"],
    timestamps=["ts"],
)

LINE_SPEC = ReconSpec(
    table="served_lines",
    keys=["l_orderkey", "l_linenumber"],
    source_fields=["l_shipdate", "l_quantity"],
    target_fields=["shipped", "quantity"],
    tie_break=["l_quantity"],
    hours=24 * 366 * 10,
)
LINES_AS_OF = datetime(2004, 1, 1)


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS r
  FROM events) WHERE r = 1
""")
def latest_event_per_user(spark, sf):
    return latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts"])


@query("""
SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
             l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS r
  FROM lineitem) WHERE r = 1
""")
def latest_line_per_order(spark, sf):
    return latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def _plain(df):
    """Amounts as doubles, which both engines hand out alike."""
    return df.withColumn("amount", F.col("amount").cast("double"))


@query(pairs.CTES + """
SELECT event_id, ts, user_id, event_type, CAST(amount AS DOUBLE) AS amount, props FROM src
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.event_id = src.event_id)
""", name="missing_records")
def missing_records_all(spark, sf):
    return _plain(missing_records(pairs.source(spark, sf), pairs.target(spark, sf), ["event_id"]))


@query("""
SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def orders_missing_lines(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return missing_records(table(spark, sf, "orders"), lines, ["o_orderkey"])


@query(pairs.CTES + """
, s AS (SELECT * FROM src WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'),
  t AS (SELECT * FROM tgt WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00')
SELECT event_id, ts, user_id, event_type, CAST(amount AS DOUBLE) AS amount FROM s
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.event_id = s.event_id)
""")
def missing_records_24h(spark, sf):
    return _plain(row_recon(pairs.source(spark, sf), pairs.target(spark, sf), EVENT_SPEC, pairs.AS_OF).missing)


_EVENT_DIFFS = """
SELECT s.event_id, 'user_id' AS column_name, CAST(s.user_id AS VARCHAR) AS src_value, CAST(t.user_id AS VARCHAR) AS tgt_value
FROM src s JOIN tgt t USING (event_id) WHERE s.user_id IS DISTINCT FROM t.user_id
UNION ALL
SELECT s.event_id, 'event_type', s.event_type, t.event_type
FROM src s JOIN tgt t USING (event_id) WHERE s.event_type IS DISTINCT FROM t.event_type
UNION ALL
SELECT s.event_id, 'amount', CAST(s.amount AS VARCHAR), CAST(t.amount AS VARCHAR)
FROM src s JOIN tgt t USING (event_id) WHERE s.amount IS DISTINCT FROM t.amount
"""


def _compared(spark, sf, null_safe=True):
    return compare_rows(
        pairs.source(spark, sf), pairs.target(spark, sf), ["event_id"], EVENT_SPEC.compare, null_safe=null_safe
    )


@query(pairs.CTES + _EVENT_DIFFS, name="column_diff")
def column_diff_long(spark, sf):
    return column_diff(_compared(spark, sf), ["event_id"], EVENT_SPEC.compare)


@query(pairs.CTES + """
SELECT concat_ws(' ',
         CASE WHEN s.user_id <> t.user_id THEN concat_ws(' ', 'user_id', 'src1', CAST(s.user_id AS VARCHAR), 'tgt1', CAST(t.user_id AS VARCHAR)) END,
         CASE WHEN s.event_type <> t.event_type THEN concat_ws(' ', 'event_type', 'src1', s.event_type, 'tgt1', t.event_type) END,
         CASE WHEN s.amount <> t.amount THEN concat_ws(' ', 'amount', 'src1', CAST(s.amount AS VARCHAR), 'tgt1', CAST(t.amount AS VARCHAR)) END
       ) AS difference,
       s.event_id, 'served_events' AS table_name, 'event_id' AS primary_key,
       CAST(s.event_id AS VARCHAR) AS primary_key_id, '2024-01-15' AS date
FROM src s JOIN tgt t USING (event_id)
WHERE s.user_id <> t.user_id OR s.event_type <> t.event_type OR s.amount <> t.amount
""")
def column_diff_text(spark, sf):
    return diff_text(
        _compared(spark, sf, null_safe=False), ["event_id"], EVENT_SPEC.compare, "served_events", pairs.AS_OF.date()
    )


@query(pairs.CTES + """
SELECT CASE WHEN t.event_id IS NULL THEN 'source' WHEN s.event_id IS NULL THEN 'target' ELSE 'both' END AS present_in,
       count(*) AS row_count,
       count(*) FILTER (WHERE s.event_id IS NOT NULL AND t.event_id IS NOT NULL AND (
         s.user_id IS DISTINCT FROM t.user_id OR s.event_type IS DISTINCT FROM t.event_type
         OR s.amount IS DISTINCT FROM t.amount)) AS mismatches
FROM src s FULL JOIN tgt t ON s.event_id = t.event_id GROUP BY 1
""")
def row_presence(spark, sf):
    return _compared(spark, sf).groupBy("present_in").agg(
        F.count("*").alias("row_count"), F.count_if("is_mismatch").alias("mismatches")
    )


def _summary_sql(table_name: str, columns: int, mismatch: str, key: str) -> str:
    return f"""
SELECT '{table_name}' AS table_name,
       (SELECT count(*) FROM s) AS source_record_count,
       (SELECT count(*) FROM sl) AS source_row_count,
       (SELECT count(*) FROM t) AS target_row_count,
       (SELECT count(*) FROM sl) - (SELECT count(*) FROM t) AS difference_total_row_count,
       {columns} AS source_column_count, {columns} AS target_column_count, 0 AS difference_total_column_count,
       (SELECT count(*) FROM sl ANTI JOIN t USING ({key})) AS missing_record_count,
       (SELECT count(*) FROM sl JOIN t USING ({key}) WHERE {mismatch}) AS mismatched_record_count
"""


@query(pairs.CTES + """
, s AS (SELECT * FROM src WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00'),
  sl AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS r FROM s) WHERE r = 1),
  t AS (SELECT * FROM tgt WHERE ts >= TIMESTAMP '2024-01-14 12:00:00' AND ts < TIMESTAMP '2024-01-15 12:00:00')
""" + _summary_sql(
    "served_events",
    5,
    "sl.user_id IS DISTINCT FROM t.user_id OR sl.event_type IS DISTINCT FROM t.event_type OR sl.amount IS DISTINCT FROM t.amount",
    "event_id",
), name="recon_summary")
def recon_summary_24h(spark, sf):
    return row_recon(pairs.source(spark, sf), pairs.target(spark, sf), EVENT_SPEC, pairs.AS_OF).summary


_LINE_CTES = f"""
WITH t AS ({pairs.LINES.format(lineitem='lineitem')}), s AS (SELECT * FROM lineitem),
sl AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_quantity DESC NULLS LAST) AS r FROM s) WHERE r = 1)
"""


def line_recon(spark, sf):
    """Latest version of every order line against the order system's lines."""
    return row_recon(table(spark, sf, "lineitem"), pairs.served_lines(spark, sf), LINE_SPEC, LINES_AS_OF, hot=None)


@query(_LINE_CTES + _summary_sql(
    "served_lines",
    4,
    "sl.l_shipdate IS DISTINCT FROM t.shipped OR sl.l_quantity IS DISTINCT FROM t.quantity",
    "l_orderkey, l_linenumber",
))
def recon_summary_lines(spark, sf):
    return line_recon(spark, sf).summary


@query(_LINE_CTES + """
SELECT l_orderkey, l_linenumber, 'l_shipdate' AS column_name, strftime(sl.l_shipdate, '%Y-%m-%d %H:%M:%S') AS src_value,
       strftime(t.shipped, '%Y-%m-%d %H:%M:%S') AS tgt_value
FROM sl JOIN t USING (l_orderkey, l_linenumber) WHERE sl.l_shipdate IS DISTINCT FROM t.shipped
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_quantity', CAST(sl.l_quantity AS VARCHAR), CAST(t.quantity AS VARCHAR)
FROM sl JOIN t USING (l_orderkey, l_linenumber) WHERE sl.l_quantity IS DISTINCT FROM t.quantity
""")
def line_differences(spark, sf):
    return line_recon(spark, sf).differences


@query(_LINE_CTES + """
SELECT 'counts' AS part, (SELECT count(*) FROM s) AS a, (SELECT count(*) FROM sl) AS b, (SELECT count(*) FROM t) AS c
UNION ALL
SELECT 'missing', count(*), CAST(sum(l_orderkey) AS BIGINT), CAST(sum(l_quantity) AS BIGINT) FROM sl ANTI JOIN t USING (l_orderkey, l_linenumber)
UNION ALL
SELECT 'differences', count(*), CAST(sum(l_orderkey) AS BIGINT), 0 FROM (
  SELECT l_orderkey FROM sl JOIN t USING (l_orderkey, l_linenumber) WHERE sl.l_shipdate IS DISTINCT FROM t.shipped
  UNION ALL
  SELECT l_orderkey FROM sl JOIN t USING (l_orderkey, l_linenumber) WHERE sl.l_quantity IS DISTINCT FROM t.quantity)
""")
def recon_published(spark, sf):
    """One pass over both sides; everything else comes from the rows that are not equal."""
    done = publish_recon(line_recon(spark, sf), shared_dir(spark, "exceptions"))
    n = F.count("*")
    counts = [("counts", *(done.counts[c] for c in ("source_record_count", "source_row_count", "target_row_count")))]
    return (
        spark.createDataFrame(counts, "part string, a bigint, b bigint, c bigint")
        .unionAll(done.missing.agg(F.lit("missing"), n, F.sum("l_orderkey"), F.sum("l_quantity").cast("long")))
        .unionAll(done.differences.agg(F.lit("differences"), n, F.sum("l_orderkey"), F.lit(0).cast("long")))
    )


@query(_LINE_CTES + "SELECT * FROM sl ANTI JOIN t USING (l_orderkey, l_linenumber)")
def missing_lines(spark, sf):
    return line_recon(spark, sf).missing


_COUNTS_SINGLE = """
, l AS (SELECT event_type, count(*) AS left_count FROM src GROUP BY event_type),
  r AS (SELECT event_type, count(*) AS right_count FROM tgt GROUP BY event_type)
"""

_COUNTS_BY_DAY = """
, l AS (SELECT event_type AS left_event_type, strftime(ts, '%Y-%m-%d') AS left_day, count(*) AS left_count FROM src GROUP BY ALL),
  r AS (SELECT event_type AS right_event_type, strftime(ts, '%Y-%m-%d') AS right_day, count(*) AS right_count FROM tgt GROUP BY ALL)
"""

_STATUS = """
left_count - right_count AS differences,
CASE WHEN left_count - right_count = 0 THEN 'success' ELSE 'Failure' END AS run_status,
CASE WHEN right_count IS NULL THEN 'left' WHEN left_count IS NULL THEN 'right' ELSE 'both' END AS present_in
"""


@query(pairs.CTES + _COUNTS_SINGLE + f"""
SELECT event_type, left_count, right_count, 'events_by_type' AS ctrl_name, 'served_events' AS table_name, {_STATUS}
FROM l FULL JOIN r USING (event_type)
""")
def count_recon_single(spark, sf):
    left = pairs.source(spark, sf).groupBy("event_type").agg(F.count("*").alias("left_count"))
    right = pairs.target(spark, sf).groupBy("event_type").agg(F.count("*").alias("right_count"))
    return count_recon(left, right, ["event_type"], "events_by_type", "served_events")


def _by_day(df, side):
    return df.groupBy(
        F.col("event_type").alias(f"{side}_event_type"), F.date_format("ts", "yyyy-MM-dd").alias(f"{side}_day")
    ).agg(F.count("*").alias(f"{side}_count"))


def _recon_by_day(spark, sf):
    return count_recon(
        _by_day(pairs.source(spark, sf), "left"),
        _by_day(pairs.target(spark, sf), "right"),
        ["event_type", "day"],
        "events_by_day",
        "served_events",
    )


_BY_DAY_SQL = pairs.CTES + _COUNTS_BY_DAY + f"""
, recon AS (SELECT l.*, r.*, 'events_by_day' AS ctrl_name, 'served_events' AS table_name, {_STATUS}
  FROM l FULL JOIN r ON left_event_type = right_event_type AND left_day = right_day)
"""


_TEXT_COUNTS = """
SELECT * REPLACE (CAST(left_count AS VARCHAR) AS left_count, CAST(right_count AS VARCHAR) AS right_count,
                  CAST(differences AS VARCHAR) AS differences)
"""
_NULLABLE = ("left_count", "right_count", "differences")


@query(_BY_DAY_SQL + _TEXT_COUNTS + "FROM recon")
def count_recon_composite(spark, sf):
    return as_text(_recon_by_day(spark, sf), *_NULLABLE)


@query(_BY_DAY_SQL + """
SELECT ctrl_name, '{"rule_name":"events_by_day",'
  || CASE WHEN differences IS NULL THEN '' ELSE '"differences":' || differences || ',' END
  || CASE WHEN left_event_type IS NULL THEN '' ELSE '"left_event_type":"' || left_event_type || '",' END
  || CASE WHEN left_day IS NULL THEN '' ELSE '"left_day":"' || left_day || '",' END
  || '"job_run_time":"2024-01-15T17:00:00.123456Z","job_run_time_est":"2024-01-15T12:00:00.123456Z",'
  || '"content_type":"reconciliation_data","run_id":"r1"}' AS alert
FROM recon WHERE run_status = 'Failure'
""", name="recon_alerts")
def recon_alerts_failed(spark, sf):
    return recon_alerts(failed_groups(_recon_by_day(spark, sf)), ["left_event_type", "left_day"], STAMP)


@query(_BY_DAY_SQL + _TEXT_COUNTS + ", TIMESTAMP '2024-01-15 12:00:00' AS run_time, 'r1' AS run_id FROM recon")
def audit_append(spark, sf):
    path = shared_dir(spark, "audit")
    name = "audit_" + path.rsplit("-", 1)[1]
    empty = _recon_by_day(spark, sf).limit(0)
    spark.sql(
        f"CREATE TABLE {name} ({_ddl(empty)}, run_time TIMESTAMP_NTZ, run_id STRING) USING parquet LOCATION '{path}'"
    )
    append_audit(_recon_by_day(spark, sf), name, STAMP)
    spark.sql(f"DROP TABLE {name}")
    return as_text(spark.read.parquet(path), *_NULLABLE)


def _ddl(df):
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


@query("""
SELECT 'status' AS ctrl_name, o_orderstatus AS grp, count(*) AS left_count, count(*) FILTER (WHERE o_totalprice > 0) AS right_count,
       0 AS differences, 'success' AS run_status, 'both' AS present_in, 'orders' AS table_name FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT 'lines', l.grp, l.c, r.c, l.c - r.c, CASE WHEN l.c - r.c = 0 THEN 'success' ELSE 'Failure' END, 'both', 'lineitem'
FROM (SELECT l_linestatus AS grp, count(*) AS c FROM lineitem GROUP BY 1) l
JOIN (SELECT l_linestatus AS grp, count(DISTINCT l_orderkey) AS c FROM lineitem GROUP BY 1) r USING (grp)
""")
def count_controls(spark, sf):
    specs = [
        CountReconSpec(
            "status",
            "orders",
            "SELECT o_orderstatus AS grp, count(*) AS left_count FROM {orders} GROUP BY o_orderstatus",
            "SELECT o_orderstatus AS grp, count(*) AS right_count FROM {orders} WHERE o_totalprice > :floor GROUP BY o_orderstatus",
            ["grp"],
        ),
        CountReconSpec(
            "lines",
            "lineitem",
            "SELECT l_linestatus AS grp, count(*) AS left_count FROM {lineitem} GROUP BY l_linestatus",
            "SELECT l_linestatus AS grp, count(DISTINCT l_orderkey) AS right_count FROM {lineitem} GROUP BY l_linestatus",
            ["grp"],
        ),
    ]
    views = {n: table(spark, sf, n) for n in ("orders", "lineitem")}
    return run_count_controls(spark, specs, views, {"floor": 0})


RULES = [
    DQRule(
        "order_without_lines",
        "SELECT o.o_orderkey, o.o_custkey FROM {orders} o LEFT ANTI JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey",
        ["o_orderkey", "o_custkey"],
    ),
    DQRule(
        "order_without_customer",
        "SELECT o.o_orderkey FROM {orders} o LEFT ANTI JOIN {customer} c ON o.o_custkey = c.c_custkey",
        ["o_orderkey"],
    ),
    DQRule("negative_balance", "SELECT c_custkey, c_name FROM {customer} WHERE c_acctbal < :floor", ["c_custkey", "c_name"]),
    DQRule(
        "duplicate_line",
        "SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
        ["l_orderkey", "l_linenumber", "n"],
    ),
]

_FAILURES = """
WITH f AS (
  SELECT 'order_without_lines' AS rule_name, json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey) AS record
  FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
  UNION ALL
  SELECT 'order_without_customer', json_object('o_orderkey', o_orderkey)
  FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
  UNION ALL
  SELECT 'negative_balance', json_object('c_custkey', c_custkey, 'c_name', c_name) FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT 'duplicate_line', json_object('l_orderkey', l_orderkey, 'l_linenumber', l_linenumber, 'n', count(*))
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
"""


def _failures(spark, sf):
    views = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    return run_rules(spark, RULES, STAMP, views, {"floor": 0})


@query(_FAILURES + """
SELECT rule_name, CAST(record AS VARCHAR) AS record, '2024-01-15T17:00:00.123456Z' AS job_run_time,
       '2024-01-15T12:00:00.123456Z' AS job_run_time_est, 'r1' AS run_id FROM f
""")
def dq_failures(spark, sf):
    return _failures(spark, sf)


FUSED = [
    OrphanRule("order_without_lines", "orders", ["o_orderkey"], "lineitem", ["l_orderkey"], ["o_orderkey", "o_custkey"]),
    OrphanRule("order_without_customer", "orders", ["o_custkey"], "customer", ["c_custkey"], ["o_orderkey"]),
    RowRule("negative_balance", "customer", "c_acctbal < 0", ["c_custkey", "c_name"]),
    UniqueRule("duplicate_line", "lineitem", ["l_orderkey", "l_linenumber"]),
]


@query(_FAILURES + """
, g AS (
  SELECT * FROM f
  UNION ALL SELECT 'cheap_order', json_object('o_orderkey', o_orderkey) FROM orders WHERE o_totalprice < 2000
  UNION ALL SELECT 'open_order', json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 5000)
SELECT rule_name, CAST(record AS VARCHAR) AS record, '2024-01-15T17:00:00.123456Z' AS job_run_time,
       '2024-01-15T12:00:00.123456Z' AS job_run_time_est, 'r1' AS run_id FROM g
""")
def dq_fused(spark, sf):
    """The rules of ``dq_failures`` and two more on orders, which are read once for four rules."""
    more = [
        RowRule("cheap_order", "orders", "o_totalprice < 2000", ["o_orderkey"]),
        RowRule("open_order", "orders", "o_orderstatus = 'O' AND o_totalprice < 5000", ["o_orderkey", "o_orderstatus"]),
    ]
    return run_fused(FUSED + more, {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")}, STAMP)


@query(_FAILURES + """
SELECT r.rule_name, count(f.rule_name) AS failed_rows, CASE WHEN count(f.rule_name) > 0 THEN 'failed' ELSE 'passed' END AS status
FROM (VALUES ('order_without_lines'), ('order_without_customer'), ('negative_balance'), ('duplicate_line')) r(rule_name)
LEFT JOIN f ON f.rule_name = r.rule_name GROUP BY r.rule_name
""")
def dq_summary(spark, sf):
    return rule_summary(_failures(spark, sf), RULES)


_NESTED = ["metadata.eventMessage.sourceSystem.correlationId", "metadata.eventMessage.sourceSystem.eventName",
           "metadata.eventMessage.sourceSystem.name"]


def snapshots(spark, sf):
    """Events wrapped the way a message bus delivers them."""
    system = F.struct(
        F.col("user_id").cast("string").alias("correlationId"),
        F.col("event_type").alias("eventName"),
        F.lit("web").alias("name"),
    )
    return table(spark, sf, "events").select(
        F.struct(F.struct(system.alias("sourceSystem")).alias("eventMessage")).alias("metadata"), "event_id", "value"
    )


_GROUPS = "SELECT CAST(user_id AS VARCHAR) AS \"correlationId\", event_type AS \"eventName\", 'web' AS name, count(*) AS rows"


@query(f"{_GROUPS} FROM events GROUP BY ALL", name="landing_stats")
def landing_stats_groups(spark, sf):
    return landing_stats(snapshots(spark, sf), _NESTED)


@query(f"""
SELECT *, false AS is_total FROM ({_GROUPS} FROM events GROUP BY ALL)
UNION ALL SELECT NULL, NULL, NULL, count(*), true FROM events
""")
def landing_stats_total(spark, sf):
    return landing_stats(snapshots(spark, sf), _NESTED, total=True)


@query("""
SELECT (SELECT count(*) FROM lineitem) AS row_total,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS key_total
""")
def row_and_key_counts(spark, sf):
    # The row count is observed while the key count runs, so the table is read once.
    lines, seen = counted(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))
    keys = distinct_keys(lines, ["l_orderkey", "l_linenumber"]).first()["keys"]
    return spark.createDataFrame([(seen.get["rows"], keys)], "row_total bigint, key_total bigint")


@query("""
SELECT o_orderkey, o_orderdate AS placed_at, round(o_totalprice * 2, 2) AS doubled, o_orderpriority AS priority,
       'orders' AS table_name FROM orders
""")
def align_names_exprs(spark, sf):
    projected = project_exprs(
        table(spark, sf, "orders"),
        ["o_orderkey"],
        ["o_orderdate", "doubled", "o_orderpriority"],
        {"doubled": "round(o_totalprice * 2, 2)"},
    )
    renamed = align_names(
        projected, ["o_orderkey"], ["placed_at", "doubled", "priority"], ["o_orderdate", "doubled", "o_orderpriority"]
    )
    return tag(renamed, table_name="orders")


@query("""
SELECT event_id, ts, CAST(TRY_CAST(k AS BIGINT) AS VARCHAR) AS k, user_id,
       CASE WHEN TRY_CAST(k AS BIGINT) IS NULL AND k IS NOT NULL THEN 1 ELSE 0 END AS lost
FROM (SELECT *, CASE WHEN event_type = 'error' THEN props ELSE json_extract_string(props, '$.k') END AS k FROM events)
""", name="align_types")
def align_types_text(spark, sf):
    """Everything arrives as text; errors bring the whole payload where a number is expected."""
    events = table(spark, sf, "events")
    k = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.get_json_object("props", "$.k"))
    text = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
        k.alias("k"),
        F.col("user_id").cast("string").alias("user_id"),
    )
    typed = events.select("event_id", "user_id", F.lit(0).cast("long").alias("k"))
    return as_text(align_types(normalise_ts(text, ["ts"]), typed, ["event_id", "user_id", "k"], lost="lost"), "k")


@query(pairs.CTES + """
SELECT event_id, ts, user_id, event_type, CAST(amount AS DOUBLE) AS amount, props FROM src
WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.event_id = src.event_id)
""", name="export_missing")
def export_missing_csv(spark, sf):
    path = shared_dir(spark, "missing")
    missing = missing_records(pairs.source(spark, sf), pairs.target(spark, sf), ["event_id"])
    export_missing(missing, path)
    return _plain(spark.read.schema(missing.schema).csv(path, header=True))


@query("""
SELECT doc_id, replace(replace(text, 'the', '***'), ' le ', '***') AS text FROM documents
""")
def redact_text(spark, sf):
    return redact(table(spark, sf, "documents").select("doc_id", "text"), "text", ["the", " le "])
