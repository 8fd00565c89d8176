"""Latest state kept over increments, and reconciliation by digests of key buckets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakerecon import BucketedTable, count_keys, key_bitmaps, missing_records_bitmap, recon_by_digest, recon_tables, shared_dir

from . import pairs
from .registry import as_text, query, table

COMPARE = ["user_id", "event_type", "amount"]


def _increments(df, key):
    """Three overlapping increments that arrive out of order."""
    third = F.pmod(F.col(key), F.lit(3))
    return [df.filter(third != 0), df.filter(third != 2), df.filter(third != 1)]


@query("""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS r
  FROM events) WHERE r = 1
""")
def latest_state(spark, sf):
    """Latest event per user, kept over three increments, the second of which comes twice."""
    events = table(spark, sf, "events")
    kept = BucketedTable(spark, shared_dir(spark, "latest"), ["user_id"], events.columns, buckets=16)
    first, second, third = _increments(events, "event_id")
    for increment in (first, second, second, third):
        kept.upsert(increment, ["ts"])
    return kept.rows().select(events.columns)


_EXCEPTIONS = """
SELECT coalesce(s.event_id, t.event_id) AS event_id,
       CASE WHEN t.event_id IS NULL THEN 'source' WHEN s.event_id IS NULL THEN 'target' ELSE 'both' END AS present_in,
       CAST(s.user_id AS VARCHAR) AS src_user, CAST(t.user_id AS VARCHAR) AS tgt_user,
       CAST(s.amount AS VARCHAR) AS src_amount, CAST(t.amount AS VARCHAR) AS tgt_amount
FROM src s FULL JOIN tgt t ON s.event_id = t.event_id
WHERE s.event_id IS NULL OR t.event_id IS NULL OR s.user_id IS DISTINCT FROM t.user_id
   OR s.event_type IS DISTINCT FROM t.event_type OR s.amount IS DISTINCT FROM t.amount
"""


def _exceptions(found):
    values = [F.col(f"_{side}.{c}").cast("string").alias(f"{side}_{c.split('_')[0]}") for side in ("src", "tgt") for c in ("user_id", "amount")]
    return found.exceptions.select("event_id", "present_in", *values)


@query(pairs.CTES + _EXCEPTIONS, name="recon_by_digest")
def recon_by_digest_events(spark, sf):
    """Two feeds of which most rows agree: only rows of differing leaves are joined."""
    return _exceptions(recon_by_digest(pairs.source(spark, sf), pairs.target(spark, sf), ["event_id"], COMPARE))


@query(pairs.CTES + f"""
SELECT * REPLACE (CAST(event_id AS VARCHAR) AS event_id) FROM ({_EXCEPTIONS})
UNION ALL SELECT 'all', 'counts', CAST((SELECT count(*) FROM src) AS VARCHAR), CAST((SELECT count(*) FROM tgt) AS VARCHAR), NULL, NULL
""", name="recon_bucketed")
def recon_bucketed_events(spark, sf):
    """The source as it is kept over increments, against a stored copy: only buckets that differ are read."""
    columns = ["event_id", "ts", *COMPARE]
    source, target = (BucketedTable(spark, shared_dir(spark, "recon"), ["event_id"], COMPARE, buckets=16, leaves=512) for _ in range(2))
    for increment in _increments(pairs.source(spark, sf).select(columns), "event_id"):
        source.upsert(increment, ["ts"])
    target.replace(pairs.target(spark, sf).select(columns))
    found = recon_tables(source, target)
    counts = [("all", "counts", *(str(found.counts[f"{side}_row_count"]) for side in ("source", "target")), None, None)]
    rows = as_text(_exceptions(found), "event_id").select("event_id", "present_in", "src_user", "tgt_user", "src_amount", "tgt_amount")
    return rows.unionAll(spark.createDataFrame(counts, rows.schema))


@query("""
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity < 30 AND l_orderkey IS NOT NULL)
""")
def missing_orders_bitmap(spark, sf):
    """Orders none of whose lines is small, by bitmaps of their keys."""
    small = table(spark, sf, "lineitem").filter("l_quantity < 30").withColumnRenamed("l_orderkey", "o_orderkey")
    return missing_records_bitmap(table(spark, sf, "orders"), small, "o_orderkey")


@query("SELECT 'orders' AS feed, count(DISTINCT o_orderkey) AS keys FROM orders UNION ALL SELECT 'lineitem', count(DISTINCT l_orderkey) FROM lineitem")
def distinct_keys_bitmap(spark, sf):
    feeds = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    one, other = (count_keys(key_bitmaps(table(spark, sf, f), k)).select(F.lit(f).alias("feed"), "keys") for f, k in feeds.items())
    return one.unionAll(other)
