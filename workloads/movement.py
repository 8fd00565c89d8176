"""Payload handling, incremental reads, SQL steps, relational loading."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lakerecon import (
    BatchSpec,
    HighWater,
    IngestSpec,
    LoadSpec,
    extract_keys,
    flatten_payload,
    hash_predicates,
    ingest_history,
    load_frame,
    read_events,
    read_increment,
    rows_as_json,
    run_batch,
    run_sql_step,
    shared_dir,
    split_payload,
    unbox,
)
from lakerecon.model import PARTITION_COLUMN

from . import landing, pairs
from .registry import query, table


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def extract_key(spark, sf):
    return extract_keys(table(spark, sf, "events").select("event_id", "props"), "props", {"$.k": "k"}).drop("props")


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.absent') AS absent FROM events
""", name="extract_keys")
def extract_many_keys(spark, sf):
    paths = {"$.k": "k", "$.absent": "absent"}
    return extract_keys(table(spark, sf, "events").select("event_id", "props"), "props", paths).drop("props")


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id, '2024-02-01' AS event_creation_time FROM events")
def unbox_payload(spark, sf):
    parsed = unbox(table(spark, sf, "events").select("event_id", "props"), "props", "k BIGINT")
    return flatten_payload(parsed, keep=["event_id"], event_creation_time="2024-02-01")


_SPLIT = f"""
WITH b AS ({landing.BROKEN})
SELECT event_type, count(*) FILTER (WHERE json_valid(payload)) AS good, count(*) FILTER (WHERE payload IS NULL OR NOT json_valid(payload)) AS bad
FROM b GROUP BY event_type
"""


@query(_SPLIT)
def quarantine_split(spark, sf):
    good, bad = split_payload(landing.broken_events(spark, sf), "payload", "k BIGINT")
    both = good.select("event_type", F.lit(1).alias("g")).unionAll(bad.select("event_type", F.lit(0).alias("g")))
    return both.groupBy("event_type").agg(F.count_if(F.col("g") == 1).alias("good"), F.count_if(F.col("g") == 0).alias("bad"))


@query("SELECT CAST(json_object('event_id', event_id, 'user_id', user_id, 'event_type', event_type) AS VARCHAR) AS json FROM events")
def rows_to_json(spark, sf):
    return rows_as_json(table(spark, sf, "events").select("event_id", "user_id", "event_type"))


@query("""
SELECT * FROM events WHERE (ts, event_id) > (SELECT (max(ts), max(event_id)) FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00')
""")
def increment_scan(spark, sf):
    events = table(spark, sf, "events")
    keys = ["ts", "event_id"]
    marks = HighWater(spark, shared_dir(spark, "marks"), "events")
    before = events.filter(F.col("ts") < F.lit(str(pairs.AS_OF)).cast("timestamp_ntz"))
    marks.commit(before.agg(F.max(F.struct(*keys)).alias("m")).first()["m"], events.select(*keys).schema)
    return read_increment(events, keys, marks.load())


@query("""
SELECT slice, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM (SELECT o_orderkey, abs(o_orderkey % 7) AS slice FROM orders) GROUP BY slice
""", name="jdbc_hash_slices")
def hash_slices(spark, sf):
    """The conditions of a parallel relational scan, applied to the orders table."""
    parts = [F.when(F.expr(p), F.lit(i).cast("bigint")) for i, p in enumerate(hash_predicates("o_orderkey", 7))]
    hits = F.array_compact(F.array(*parts))
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", F.explode(hits).alias("slice"))
        .groupBy("slice")
        .agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("key_sum"))
    )


@query(f"""
WITH b AS ({landing.BROKEN}), p AS (SELECT payload, coalesce(json_valid(payload), false) AS ok FROM b)
SELECT 'landed' AS place, count(*) AS rows, CAST(sum(CAST(json_extract(CASE WHEN ok THEN payload END, '$.k') AS BIGINT)) AS BIGINT) AS k_sum FROM p WHERE ok
UNION ALL SELECT 'quarantined', count(*), 0 FROM p WHERE NOT ok
""")
def ingest_increments(spark, sf):
    """Two runs, the second of which finds nothing beyond the mark of the first."""
    root = shared_dir(spark, "ingest")
    spec = IngestSpec(
        job="events",
        payload="payload",
        payload_schema="k BIGINT",
        bookmark_keys=["ts", "event_id"],
        out=f"{root}/raw",
        quarantine=f"{root}/error",
        files=4,
    )
    marks = HighWater(spark, f"{root}/marks", spec.job)
    for day in (date(2024, 2, 1), date(2024, 2, 2)):
        ingest_history(landing.broken_events(spark, sf), spec, marks, day)
    landed = read_events(spark, spec.out, schema=f"k BIGINT, {PARTITION_COLUMN} DATE")
    rejected = read_events(spark, spec.quarantine, schema="event_id BIGINT, error STRING")
    return landed.agg(
        F.lit("landed").alias("place"), F.count("*").alias("rows"), F.sum("k").alias("k_sum")
    ).unionAll(rejected.agg(F.lit("quarantined"), F.count("event_id"), F.lit(0).cast("long")))


@query("""
SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 1000 GROUP BY c_mktsegment
""")
def sql_step(spark, sf):
    return run_sql_step(
        spark,
        """
        SELECT c_mktsegment, count(*) AS orders,  -- comments and line breaks are kept
               CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE o_totalprice >= :floor GROUP BY c_mktsegment
        """,
        {"floor": 1000},
        {n: table(spark, sf, n) for n in ("orders", "customer")},
    )


@query("SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY ALL")
def batch_write(spark, sf):
    path = shared_dir(spark, "batch")
    name = "batch_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (l_returnflag STRING, l_linestatus STRING, lines BIGINT) USING parquet LOCATION '{path}'")
    run_batch(
        spark,
        BatchSpec(
            batch_sql="SELECT l_returnflag, l_linestatus, count(*) AS lines FROM {lineitem} GROUP BY ALL",
            write_sql=f"INSERT INTO {name} SELECT * FROM batch_output",
        ),
        {"lineitem": table(spark, sf, "lineitem")},
    )
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("""
SELECT event_id, CAST(user_id AS VARCHAR) AS policy_number, event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events WHERE event_type <> 'error'
""", name="load_history")
def load_history_frame(spark, sf):
    """Everything of a relational load but the database."""
    return load_frame(
        spark,
        LoadSpec(
            path=landing.payload_objects(spark, sf),
            schema='{"type":"struct","fields":['
            '{"name":"event_id","type":"long","nullable":true,"metadata":{}},'
            '{"name":"PolicyNumber","type":"string","nullable":true,"metadata":{}},'
            '{"name":"PayLoad","type":"string","nullable":true,"metadata":{}}]}',
            sql="""
            SELECT event_id, PolicyNumber AS policy_number, event_type, CAST(k AS INT) AS k
            FROM {input} WHERE event_type <> :refused
            """,
            table="served.events",
            extract={"$.detail.event_type": "event_type", "$.detail.k": "k"},
            params={"refused": "error"},
            max_partitions=4,
        ),
    )
