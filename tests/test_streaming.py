"""Streams against their batch forms."""

import os
from datetime import date

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from lakerecon import CompactionSpec, compact_stream, corrected_stats_stream, ingest_stream, landing_stats_stream, read_corrected_stats, read_events
from lakerecon.model import PARTITION_COLUMN

RAW = f"id BIGINT, payload STRING, {PARTITION_COLUMN} DATE"


def land(spark, root, rows):
    spark.createDataFrame(rows, f"id bigint, payload string, {PARTITION_COLUMN} string").write.mode("append").partitionBy(
        PARTITION_COLUMN
    ).json(root)


def run(spark, folder, **more):
    query = ingest_stream(
        spark,
        source=f"{folder}/in",
        schema=RAW,
        payload="payload",
        payload_schema="k BIGINT",
        out=f"{folder}/out",
        quarantine=f"{folder}/err",
        checkpoint=f"{folder}/ck",
        by=[PARTITION_COLUMN],
        feed="f",
        keep=["id", PARTITION_COLUMN],
        **more,
    )
    query.awaitTermination()
    out = read_events(spark, f"{folder}/out", schema=f"id BIGINT, k BIGINT, {PARTITION_COLUMN} DATE")
    err = read_events(spark, f"{folder}/err", schema="id BIGINT, payload STRING, error STRING")
    return sorted(r["id"] for r in out.collect()), sorted(r["id"] for r in err.collect())


def test_new_files_only(spark, folder):
    land(spark, f"{folder}/in", [(1, '{"k": 1}', "2024-01-01"), (2, "broken", "2024-01-01"), (3, '{"k": 3}', "2024-01-02")])
    assert run(spark, folder) == ([1, 3], [2])
    assert run(spark, folder) == ([1, 3], [2])
    land(spark, f"{folder}/in", [(4, '{"k": 4}', "2024-01-01"), (5, None, "2024-01-01")])
    assert run(spark, folder, max_files=1) == ([1, 3, 4], [2, 5])


def test_a_repeated_batch_replaces_itself(spark, folder):
    land(spark, f"{folder}/in", [(1, '{"k": 1}', "2024-01-01"), (2, "broken", "2024-01-01")])
    assert run(spark, folder) == ([1], [2])
    # The commit marker is written last; without it the batch counts as unfinished.
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/ck/commits/{name}")
    assert run(spark, folder) == ([1], [2])


def test_touched_dates_are_compacted(spark, folder):
    def rewrite():
        spec = CompactionSpec(schema="id BIGINT, payload STRING")
        compact_stream(spark, f"{folder}/in", f"{folder}/hist", spec, f"{folder}/ck").awaitTermination()
        got = read_events(spark, f"{folder}/hist", schema=RAW).collect()
        return sorted((r["id"], str(r[PARTITION_COLUMN])) for r in got)

    land(spark, f"{folder}/in", [(1, "a", "2024-01-01"), (2, "b", "2024-01-09")])
    assert rewrite() == [(1, "2024-01-01"), (2, "2024-01-09")]
    land(spark, f"{folder}/in", [(3, "late", "2024-01-01")])
    assert rewrite() == [(1, "2024-01-01"), (2, "2024-01-09"), (3, "2024-01-01")]


def test_stream_needs_a_schema(spark, folder):
    with pytest.raises(ValueError):
        compact_stream(spark, folder, f"{folder}x", CompactionSpec(), f"{folder}/ck")


def test_only_closed_windows_are_emitted(spark, folder):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
    stats = landing_stats_stream(stream, "ts", ["event_type"], "1 day", "1 hour")
    stats.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(
        availableNow=True
    ).start().awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    want = events.filter(F.to_date("ts") < date(2024, 1, 30)).groupBy(F.to_date("ts").alias("d"), "event_type").count()
    assert sorted((str(r["window_start"])[:10], r["event_type"], r["rows"]) for r in got.collect()) == sorted(
        (str(r["d"]), r["event_type"], r["count"]) for r in want.collect()
    )


def undo_last_batch(checkpoint):
    """As after a crash: the batch's work is done, its commit marker is not there."""
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    return last


def test_a_delivery_is_landed_once(spark, folder):
    day = "2024-01-01"
    land(spark, f"{folder}/in", [(1, '{"k": 1}', day), (1, '{"k": 9}', day), (2, "broken", day), (None, '{"k": 4}', day), (None, '{"k": 4}', day)])
    once = lambda: _ids(run_raw(spark, folder, unique=["id"]))
    assert once() == ([1, "none", "none"], [2])
    land(spark, f"{folder}/in", [(1, '{"k": 1}', day), (2, "broken", day), (3, '{"k": 3}', "2023-01-01"), (None, "broken", day)])
    assert once() == ([1, 3, "none", "none"], [2, "none"])
    undo_last_batch(f"{folder}/ck")
    assert once() == ([1, 3, "none", "none"], [2, "none"])
    land(spark, f"{folder}/in", [(3, '{"k": 3}', day), (4, '{"k": 3}', day), (4, '{"k": 3}', day)])
    assert _ids(run_raw(spark, folder, unique=["id"], max_files=1)) == ([1, 3, 4, "none", "none"], [2, "none"])


def run_raw(spark, folder, **more):
    ingest_stream(
        spark, f"{folder}/in", RAW, "payload", "k BIGINT", f"{folder}/out", f"{folder}/err", f"{folder}/ck", [PARTITION_COLUMN], "f",
        keep=["id", PARTITION_COLUMN], **more,
    ).awaitTermination()
    out = read_events(spark, f"{folder}/out", schema=f"id BIGINT, k BIGINT, {PARTITION_COLUMN} DATE")
    err = read_events(spark, f"{folder}/err", schema="id BIGINT, payload STRING, error STRING")
    return out, err


def _ids(frames):
    return tuple(sorted((r["id"] if r["id"] is not None else "none" for r in df.collect()), key=str) for df in frames)


def test_late_rows_correct_windows(spark, folder):
    rows = [(1, "2024-01-05 10:00:00", "a"), (2, "2024-01-05 11:00:00", "b"), (3, "2024-01-01 01:00:00", "a"), (4, None, "a"), (5, "2024-01-05 23:59:59", None)]
    schema = "id BIGINT, ts TIMESTAMP, body STRUCT<kind STRING>, head STRUCT<kind STRING>"

    def arrive(part):
        df = spark.createDataFrame(part, "id long, ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
        df.select("id", "ts", F.struct("kind").alias("body"), F.struct(F.lit("x").alias("kind")).alias("head")).coalesce(1).write.mode("append").json(f"{folder}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
        corrected_stats_stream(stream, "ts", ["body.kind", "head.kind"], f"{folder}/out", f"{folder}/ck", fold_every=2).awaitTermination()
        return {(str(r.window_start)[:10], r.body_kind, r.head_kind): r.rows for r in read_corrected_stats(spark, f"{folder}/out").collect()}

    assert read_corrected_stats(spark, f"{folder}/out") is None
    assert arrive(rows[:2]) == {("2024-01-05", "a", "x"): 1, ("2024-01-05", "b", "x"): 1}
    second = {("2024-01-05", "a", "x"): 1, ("2024-01-05", "b", "x"): 1, ("2024-01-05", None, "x"): 1, ("2024-01-01", "a", "x"): 1}
    assert arrive(rows[2:]) == second
    assert undo_last_batch(f"{folder}/ck") == 1
    # batch 1 runs again, and the fold that it had written is written again
    assert arrive(rows[:1]) == {**second, ("2024-01-05", "a", "x"): 2}
    assert arrive(rows[2:3] * 3)[("2024-01-01", "a", "x")] == 4
    assert {r.upto for r in spark.read.parquet(f"{folder}/out/folded").collect()} == {1, 3}
    before = read_corrected_stats(spark, f"{folder}/out", 0)
    assert {(r.body_kind, r.rows) for r in before.collect()} == {("a", 1), ("b", 1)}


def test_windows_of_columns_with_equal_last_names(spark, folder):
    df = spark.createDataFrame([("2024-01-01 00:00:00", ("a",), ("b",))], "ts string, l struct<k string>, r struct<k string>")
    df.write.json(f"{folder}/in")
    stream = spark.readStream.schema("ts TIMESTAMP, l STRUCT<k STRING>, r STRUCT<k STRING>").json(f"{folder}/in")
    assert landing_stats_stream(stream, "ts", ["l.k", "r.k"]).columns == ["window_start", "l_k", "r_k", "rows"]
