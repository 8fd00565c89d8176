"""Listings, pending partitions, compaction, catalog partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerecon import (
    FILE_TIERS,
    CompactionSpec,
    SchemaRegistry,
    cap_partitions,
    catalog_view,
    compact,
    compact_calendar,
    compact_evolved,
    compact_packed,
    compact_registered,
    compaction_plan,
    grow_partitions,
    latest_schema,
    list_partitions,
    payload_schema,
    pending_partitions,
    read_events,
    read_partitions,
    recon_dates,
    rekey_calendar_paths,
    repair_table,
    schema_diff,
    shared_dir,
    table_partitions,
    write_raw,
)
from lakerecon.model import PARTITION_COLUMN

from . import landing, pairs
from .registry import query, table

_DAYS = f"SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN} FROM events"


def _as_text(df):
    return df.select(F.col(PARTITION_COLUMN).cast("string").alias(PARTITION_COLUMN))


@query("""
SELECT l_returnflag, count(*) AS rows, greatest(1, CAST(ceil(count(*) / 10000) AS BIGINT)) AS files
FROM lineitem GROUP BY l_returnflag
""")
def compaction_plan_rows(spark, sf):
    return compaction_plan(table(spark, sf, "lineitem"), "l_returnflag")


@query("""
SELECT feed, part, rows, CASE WHEN rows <= 1000 THEN 10 WHEN rows <= 3000 THEN 30 WHEN rows <= 5000 THEN 50 ELSE 200 END AS files
FROM (SELECT 'lineitem' AS feed, l_returnflag AS part, count(*) AS rows FROM lineitem GROUP BY ALL
      UNION ALL SELECT 'orders', o_orderpriority, count(*) FROM orders GROUP BY ALL
      UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY ALL
      UNION ALL SELECT 'documents', source, count(*) FROM documents GROUP BY ALL)
""")
def compaction_plan_tiers(spark, sf):
    feeds = {"lineitem": "l_returnflag", "orders": "o_orderpriority", "events": "event_type", "documents": "source"}
    parts = [
        table(spark, sf, name).select(F.lit(name).alias("feed"), F.col(column).alias("part"))
        for name, column in feeds.items()
    ]
    return compaction_plan(reduce(DataFrame.unionAll, parts), ["feed", "part"], tiers=FILE_TIERS)


@query(_DAYS)
def partition_listing(spark, sf):
    return _as_text(list_partitions(spark, landing.raw_events(spark, sf)))


def _pending(spark, sf, strategy):
    raw = list_partitions(spark, landing.raw_events(spark, sf))
    done = list_partitions(spark, landing.partial_history(spark, sf))
    return _as_text(pending_partitions(raw, done, strategy))


@query(_DAYS + " WHERE CAST(ts AS DATE) > DATE '2024-01-20'")
def pending_missing(spark, sf):
    return _pending(spark, sf, "missing")


@query(_DAYS + " WHERE CAST(ts AS DATE) >= DATE '2024-01-19'")
def pending_second_latest(spark, sf):
    return _pending(spark, sf, "from_second_latest")


@query(_DAYS + " WHERE CAST(ts AS DATE) >= DATE '2024-01-20'")
def pending_latest(spark, sf):
    return _pending(spark, sf, "from_latest")


@query(_DAYS)
def pending_backfill(spark, sf):
    raw = list_partitions(spark, landing.raw_events(spark, sf))
    nothing = list_partitions(spark, shared_dir(spark, "nothing"))
    return _as_text(pending_partitions(raw, nothing, "from_second_latest"))


_EVENTS = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
_DATED = f"SELECT *, strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN} FROM events"


def read_dated(spark, root):
    """Events with the value of the directory they lie in, as text."""
    df = read_events(spark, root, schema=f"{landing.EVENT_SCHEMA}, {PARTITION_COLUMN} DATE")
    return df.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("string"))


@query(_DATED)
def compact_incremental(spark, sf):
    history = landing.partial_history(spark, sf)
    spec = CompactionSpec(schema=landing.EVENT_SCHEMA, rows_per_file=1000)
    compact(spark, landing.raw_events(spark, sf), history, spec)
    return read_dated(spark, history)


@query(_DATED)
def compact_lines(spark, sf):
    """JSON lines moved as text: nothing is parsed, inferred or reformatted."""
    history = shared_dir(spark, "lines")
    spec = CompactionSpec(source_format="text", schema="value STRING", write_options={"compression": "gzip"})
    compact(spark, landing.raw_events(spark, sf), history, spec)
    return read_dated(spark, history)


@query(_DATED)
def compact_registered_feed(spark, sf):
    """Two runs over Parquet: the first registers the schema, the second finds it known."""
    root = shared_dir(spark, "registered")
    landing.dated(spark, sf).write.partitionBy(PARTITION_COLUMN).parquet(f"{root}/in")
    registry = SchemaRegistry(spark, f"{root}/schemas")
    spec = CompactionSpec(source_format="parquet")
    for _ in range(2):
        compact_registered(spark, f"{root}/in", f"{root}/out", registry, "events", pairs.AS_OF, spec)
    out = spark.read.parquet(f"{root}/out")
    return out.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("string"))


@query(f"""
SELECT event_id, CASE day % 4 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN k || '.5' WHEN 2 THEN 'x' || k ELSE '{{"inner":' || k || '}}' END AS k,
       CASE WHEN day % 4 < 2 THEN CAST(k AS DOUBLE) + CASE WHEN day % 4 = 1 THEN 0.25 ELSE 0 END END AS n_a,
       CASE WHEN day % 4 = 3 THEN CAST(k AS VARCHAR) END AS n_b, strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN}, 'k' AS conflicts
FROM (SELECT event_id, ts, event_id % 10 AS k, day(ts) AS day FROM events)
""")
def schema_lattice(spark, sf):
    """Days in which one column is a whole number, a fraction, text or an object: one reader schema, found in one pass."""
    root = shared_dir(spark, "lattice")
    day, k = F.dayofmonth("ts") % 4, F.col("event_id") % 10
    events = landing.dated(spark, sf)
    kinds = [k, k + 0.5, F.concat(F.lit("x"), k.cast("string")), F.struct(k.alias("inner"))]
    nested = [F.struct(k.alias("a")), F.struct((k + 0.25).alias("a")), F.lit(None).cast("struct<a int>"), F.struct(k.alias("b"))]
    for rest, (kind, inner) in enumerate(zip(kinds, nested)):
        part = events.filter(day == rest).select("event_id", kind.alias("k"), inner.alias("n"), PARTITION_COLUMN)
        write_raw(part, f"{root}/in", [PARTITION_COLUMN])
    registry = SchemaRegistry(spark, f"{root}/schemas")
    _, conflicts = compact_evolved(spark, f"{root}/in", f"{root}/out", registry, "events", pairs.AS_OF)
    schema = f"event_id BIGINT, k STRING, n STRUCT<a: DOUBLE, b: STRING>, {PARTITION_COLUMN} DATE"
    out = read_events(spark, f"{root}/out", schema=schema)
    return out.select("event_id", "k", F.col("n.a").alias("n_a"), F.col("n.b").alias("n_b"), F.col(PARTITION_COLUMN).cast("string").alias(PARTITION_COLUMN),
                      F.lit(",".join(conflicts)).alias("conflicts"))


_PER_DAY = "SELECT count(*) AS n FROM events GROUP BY CAST(ts AS DATE)"


@query(f"""
SELECT 'rows' AS plan, CAST(sum(ceil(n / 100)) AS BIGINT) AS planned, true AS as_planned, CAST(sum(n) AS BIGINT) AS rows FROM ({_PER_DAY})
UNION ALL
SELECT 'tiers', CAST(sum(CASE WHEN n <= 100 THEN 2 WHEN n <= 200 THEN 4 ELSE 6 END) AS BIGINT), true, CAST(sum(n) AS BIGINT) FROM ({_PER_DAY})
UNION ALL
SELECT 'bytes', 0, true, CAST(sum(n) AS BIGINT) FROM ({_PER_DAY})
""")
def compact_files(spark, sf):
    """Files planned by rows, by tiers and by bytes, against the files that a listing finds afterwards."""
    plans = {
        "rows": {"rows_per_file": 100},
        "tiers": {"tiers": ((100, 2), (200, 4), (None, 6))},
        "bytes": {"bytes_per_file": 20_000},
    }
    told = []
    for name, plan in plans.items():
        out = shared_dir(spark, f"files-{name}")
        done = compact(spark, landing.raw_events(spark, sf), out, CompactionSpec(schema=landing.EVENT_SCHEMA, shuffle=True, **plan))
        there = list_partitions(spark, out).agg(F.sum("files")).first()[0]
        told.append((name, 0 if name == "bytes" else done.planned, done.planned == done.files == there, done.rows))
    return spark.createDataFrame(told, "plan string, planned bigint, as_planned boolean, rows bigint")


@query(f"""
SELECT strftime(day, '%Y-%m-%d') AS {PARTITION_COLUMN}, CASE WHEN n <= 150 THEN 2 ELSE 4 END AS planned, CASE WHEN n <= 150 THEN 2 ELSE 4 END AS written,
       n AS rows, true AS balanced
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
""", name="compact_packed")
def compact_packed_days(spark, sf):
    """Ten small files a day, put together whole: files per day as planned, no two bins further apart than the largest file."""
    raw, out = shared_dir(spark, "small"), shared_dir(spark, "packed")
    write_raw(landing.dated(spark, sf).repartition(10), raw, [PARTITION_COLUMN])
    done = compact_packed(spark, raw, out, CompactionSpec(schema=landing.EVENT_SCHEMA, tiers=((150, 2), (None, 4))))
    told = [(str(p.value), p.planned, p.written, p.largest_bin - p.smallest_bin <= p.largest_input) for p in done.partitions]
    told = spark.createDataFrame(told, f"{PARTITION_COLUMN} string, planned int, written int, balanced boolean")
    return told.join(read_dated(spark, out).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows")), PARTITION_COLUMN)


@query(_EVENTS.replace(", props", ""))
def compact_full(spark, sf):
    out = shared_dir(spark, "full")
    spec = CompactionSpec(mode="full", schema=landing.EVENT_SCHEMA, drop=["props"])
    compact(spark, landing.raw_events(spark, sf), out, spec)
    return read_events(spark, out, schema=landing.EVENT_SCHEMA.replace(", props STRING", ""))


@query(_DATED)
def rekey_calendar(spark, sf):
    df = rekey_calendar_paths(spark, landing.calendar_events(spark, sf), schema=landing.EVENT_SCHEMA)
    return df.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("string"))


@query(_DATED)
def compact_calendar_days(spark, sf):
    history = landing.partial_history(spark, sf)
    spec = CompactionSpec(strategy="from_latest", tiers=((None, 10),), schema=landing.EVENT_SCHEMA)
    compact_calendar(spark, landing.calendar_events(spark, sf), history, spec)
    return read_dated(spark, history)


@query(_EVENTS + " WHERE CAST(ts AS DATE) IN (DATE '2024-01-14', DATE '2024-01-15')")
def scan_partitions(spark, sf):
    days = [*recon_dates(pairs.AS_OF), "2031-01-01"]
    df = read_partitions(spark, landing.raw_events(spark, sf), days, schema=landing.EVENT_SCHEMA)
    return df.drop(PARTITION_COLUMN)


@query(f"SELECT *, '2024-02-01' AS {PARTITION_COLUMN} FROM events")
def scan_raw_json(spark, sf):
    out = shared_dir(spark, "resized")
    events = grow_partitions(table(spark, sf, "events"), 8, current=1)
    write_raw(cap_partitions(events, 4), out, [PARTITION_COLUMN], fixed_value="2024-02-01")
    return read_dated(spark, out)


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props,
       strftime(ts, '%Y-%m-%d') AS event_creation_time FROM events
""")
def scan_inferred_json(spark, sf):
    df = read_events(spark, landing.raw_events(spark, sf))
    return df.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("string"))


@query(f"SELECT strftime(ts, '%Y-%m-%d') AS {PARTITION_COLUMN}, count(*) AS rows FROM events GROUP BY 1", name="repair_table")
def repaired_table(spark, sf):
    raw = landing.raw_events(spark, sf)
    out = shared_dir(spark, "repaired")
    name = "raw_" + out.rsplit("-", 1)[1]
    spark.sql(
        f"CREATE TABLE {name} ({landing.EVENT_SCHEMA}, {PARTITION_COLUMN} DATE) USING json "
        f"PARTITIONED BY ({PARTITION_COLUMN}) LOCATION '{raw}'"
    )
    repair_table(spark, name)
    known = table_partitions(spark, name, PARTITION_COLUMN)
    counts = spark.table(name).groupBy(PARTITION_COLUMN).agg(F.count("*").alias("rows"))
    found = counts.join(known, PARTITION_COLUMN)
    # The catalog is asked again when the query runs, so the result is kept before the table goes.
    found.withColumn(PARTITION_COLUMN, F.col(PARTITION_COLUMN).cast("string")).write.parquet(out)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(out)


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL")
def catalog_scan(spark, sf):
    path = shared_dir(spark, "orders")
    name = "orders_" + path.rsplit("-", 1)[1]
    table(spark, sf, "orders").write.option("path", path).saveAsTable(name)
    catalog_view(spark, name, f"{name}_view")
    out = spark.sql(
        f"SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM {name}_view GROUP BY o_orderstatus, o_orderpriority"
    )
    spark.sql(f"DROP TABLE {name}")
    return out


@query("""
WITH observed AS (
  SELECT k AS path, CASE WHEN bool_and(t IN ('UBIGINT', 'BIGINT')) THEN 'bigint' ELSE 'string' END AS type
  FROM (SELECT unnest(json_keys(props)) AS k, json_type(props, '$.' || unnest(json_keys(props))) AS t FROM events) GROUP BY k),
registered AS (SELECT * FROM (VALUES ('k', 'string'), ('n', 'int')) v(path, type))
SELECT path, CASE WHEN r.type IS NULL THEN 'added' WHEN o.type IS NULL THEN 'removed' ELSE 'changed' END AS change,
       r.type AS old_type, o.type AS new_type
FROM registered r FULL JOIN observed o USING (path) WHERE r.type IS DISTINCT FROM o.type
""")
def schema_drift(spark, sf):
    observed = payload_schema(table(spark, sf, "events"), "props")
    return schema_diff(spark, "k STRING, n INT", observed).select("path", "change", "old_type", "new_type")


@query("""
SELECT column_name AS path, 'added' AS change,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS new_type
FROM (DESCRIBE SELECT event_id, ts, user_id, event_type, value, props FROM events) d(column_name, data_type, n, k, f, e)
""")
def newest_file_schema(spark, sf):
    found = latest_schema(spark, landing.raw_events(spark, sf))
    fields = [f for f in found if f.name != PARTITION_COLUMN]
    return schema_diff(spark, type(found)([]), type(found)(fields)).select("path", "change", "new_type")
