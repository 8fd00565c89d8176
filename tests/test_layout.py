"""Plans, pending partitions and compaction."""

import glob
import math
import os
import time
from datetime import date, datetime

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from lakerecon import (
    FILE_TIERS,
    FIXED_FILES,
    CompactionSpec,
    cap_partitions,
    compact,
    compact_calendar,
    compaction_plan,
    has_rows,
    latest_schema,
    list_calendar,
    list_files,
    list_partitions,
    partition_exists,
    pending_partitions,
    read_calendar,
    read_events,
    read_partitions,
    write_history,
)
from lakerecon.model import PARTITION_COLUMN
from lakerecon.operators import compaction
from lakerecon.operators.compaction import PartitionPlan, spread_over_files
from lakerecon.operators.layout import files_for

SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def days(spark, *texts):
    return spark.createDataFrame([(date.fromisoformat(t),) for t in texts], f"{PARTITION_COLUMN} date")


def pending(spark, strategy, source, target):
    got = pending_partitions(days(spark, *source), days(spark, *target), strategy)
    return sorted(str(r[0]) for r in got.collect())


DAYS = ["2024-01-04", "2024-01-01", "2024-01-03", "2024-01-02"]


@pytest.mark.parametrize(
    "strategy, target, want",
    [
        ("missing", [], sorted(DAYS)),
        ("missing", ["2024-01-02", "2024-01-04"], ["2024-01-01", "2024-01-03"]),
        ("missing", DAYS, []),
        ("from_latest", [], sorted(DAYS)),
        ("from_latest", ["2024-01-01", "2024-01-03"], ["2024-01-03", "2024-01-04"]),
        ("from_second_latest", [], sorted(DAYS)),
        ("from_second_latest", ["2024-01-03"], ["2024-01-03", "2024-01-04"]),
        ("from_second_latest", ["2024-01-03", "2024-01-01", "2024-01-02"], ["2024-01-02", "2024-01-03", "2024-01-04"]),
        ("from_second_latest", ["2024-01-03", "2023-12-31", "2024-01-02"], ["2024-01-02", "2024-01-03", "2024-01-04"]),
    ],
)
def test_pending(spark, strategy, target, want):
    assert pending(spark, strategy, DAYS, target) == want


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        pending(spark, "newest", DAYS, [])


def test_tiers_and_sizes(spark):
    n = spark.createDataFrame([(r,) for r in (0, 1, 1000, 1001, 3000, 3001, 5000, 5001, 10_000, 10_001)], "n bigint")
    got = n.select(files_for(F.col("n")), files_for(F.col("n"), tiers=FILE_TIERS), files_for(F.col("n"), tiers=FIXED_FILES)).collect()
    assert [r[0] for r in got] == [1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
    assert [r[1] for r in got] == [10, 10, 10, 30, 30, 50, 50, 200, 200, 200]
    assert {r[2] for r in got} == {10}
    large = n.select(files_for(F.col("n"), tiers=FIXED_FILES, max_rows_per_file=100)).collect()
    assert large[-1][0] == 101
    with pytest.raises(ValueError):
        files_for(F.col("n"), tiers=[(10, 1)])


def test_plan_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)], "x string, y int")
    got = compaction_plan(df, ["x", "y"], rows_per_file=2).orderBy("x").collect()
    assert [(r["x"], r["rows"], r["files"]) for r in got] == [("a", 3, 2), ("b", 1, 1)]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Dated raw directory in which one day holds a third of all rows, as copies of one row."""
    root = str(tmp_path_factory.mktemp("raw"))
    events = spark.read.parquet(f"{DATA}/events.parquet")
    dated = events.withColumn(PARTITION_COLUMN, F.to_date("ts"))
    copies = spark.range(5000).join(dated.orderBy("event_id").limit(1)).drop("id")
    dated.unionByName(copies).repartition(4).write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    ).mode("append").partitionBy(PARTITION_COLUMN).json(root)
    return root


def data(df):
    return sorted(map(repr, (tuple(r) for r in df.select("event_id", "ts", "props", PARTITION_COLUMN).collect())))


def read(spark, root):
    return read_events(spark, root, schema=f"{SCHEMA}, {PARTITION_COLUMN} DATE")


def files_of(root, day="*"):
    return [f for f in glob.glob(f"{root}/{PARTITION_COLUMN}={day}/*") if not os.path.basename(f).startswith(("_", "."))]


@pytest.mark.parametrize("shuffle", [True, False, None])
def test_compaction_keeps_rows_and_is_repeatable(spark, raw, folder, shuffle):
    spec = CompactionSpec(schema=SCHEMA, rows_per_file=500, shuffle=shuffle)
    first = compact(spark, raw, folder, spec)
    assert first.rows == 15_000 and len(first.partitions) == 30
    assert data(read(spark, folder)) == data(read(spark, raw))
    assert len(files_of(folder)) == first.files <= len(files_of(raw))
    before = data(read(spark, folder))
    again = compact(spark, raw, folder, spec)
    assert [str(p) for p in again.partitions] == ["2024-01-29", "2024-01-30"]
    assert data(read(spark, folder)) == before
    nothing = compact(spark, raw, folder, CompactionSpec(schema=SCHEMA, strategy="missing"))
    assert nothing == type(nothing)((), 0, 0)


def test_a_day_of_copies_is_spread_over_its_files(spark, raw, folder):
    compact(spark, raw, folder, CompactionSpec(schema=SCHEMA, rows_per_file=500, shuffle=True))
    sizes = [sum(1 for _ in open(f)) for f in files_of(folder, "2024-01-01")]
    assert len(sizes) == 11 and max(sizes) <= 600


def test_late_rows_are_picked_up(spark, raw, folder):
    day = date(2024, 1, 29)
    early = read(spark, raw).filter((F.col(PARTITION_COLUMN) < day) | (F.col("ts") < datetime(2024, 1, 29, 6)))
    write_history(early.filter(F.col(PARTITION_COLUMN) <= day), folder, [PARTITION_COLUMN])
    done = compact(spark, raw, folder, CompactionSpec(schema=SCHEMA))
    assert [str(p) for p in done.partitions] == ["2024-01-28", "2024-01-29", "2024-01-30"]
    assert data(read(spark, folder)) == data(read(spark, raw))


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_compaction_into_columns(spark, raw, folder, fmt):
    compact(spark, raw, folder, CompactionSpec(schema=SCHEMA, target_format=fmt, tiers=FILE_TIERS))
    assert data(spark.read.format(fmt).load(folder)) == data(read(spark, raw))


def test_full_compaction_drops_columns(spark, raw, folder):
    got = compact(spark, raw, f"{folder}/out", CompactionSpec(mode="full", schema=SCHEMA, drop=["props"], rows_per_file=4000))
    assert (got.rows, got.files) == (15_000, 4)
    out = spark.read.json(f"{folder}/out")
    assert "props" not in out.columns and out.count() == 15_000
    assert len(glob.glob(f"{folder}/out/part-*")) == 4


def test_compaction_never_overwrites_its_input(spark, raw):
    for target in (raw, f"{raw}/", f"{raw}/sub", os.path.dirname(raw)):
        with pytest.raises(ValueError):
            compact(spark, raw, target)


def test_a_target_with_a_similar_name_is_fine(spark, folder):
    spark.range(3).withColumn(PARTITION_COLUMN, F.lit("2024-01-01")).write.partitionBy(PARTITION_COLUMN).json(f"{folder}/raw")
    assert compact(spark, f"{folder}/raw", f"{folder}/raw_hist", CompactionSpec(schema="id BIGINT")).rows == 3


def test_unknown_mode():
    with pytest.raises(ValueError):
        CompactionSpec(mode="some")


def test_large_plans_are_not_broadcast(spark, raw, monkeypatch):
    plan = [PartitionPlan(date(2024, 1, 1), 5333, 11), PartitionPlan(date(2024, 1, 2), 333, 1)]
    df = read(spark, raw).filter(F.col(PARTITION_COLUMN) <= date(2024, 1, 2))
    want = data(df)
    monkeypatch.setattr(compaction, "MAX_BROADCAST_PARTITIONS", 1)
    assert data(spread_over_files(df, plan, PARTITION_COLUMN)) == want


def test_a_task_writes_files_of_many_partitions(spark, raw, folder, monkeypatch):
    """Tasks follow the partition with the most files and not the number of all files."""
    monkeypatch.setattr(compaction, "LEAST_TASKS", 2)
    tasks, spread = [], compaction.spread_over_files

    def seen(*args, **kwargs):
        df = spread(*args, **kwargs)
        tasks.append(df.rdd.getNumPartitions())
        return df

    monkeypatch.setattr(compaction, "spread_over_files", seen)
    done = compact(spark, raw, folder, CompactionSpec(schema=SCHEMA, rows_per_file=100, shuffle=True))
    counts = {r[0]: r[1] for r in read(spark, raw).groupBy(PARTITION_COLUMN).count().collect()}
    wanted = {day: math.ceil(n / 100) for day, n in counts.items()}
    assert tasks == [max(wanted.values())]
    assert done.files == done.planned == sum(wanted.values()) > tasks[0]
    assert {r[0]: r["files"] for r in list_partitions(spark, folder).collect()} == wanted
    assert data(read(spark, folder)) == data(read(spark, raw))


def test_jobs_are_bounded(spark, raw, folder, monkeypatch):
    """Several jobs, and a partition with more files than a job may have tasks."""
    monkeypatch.setattr(compaction, "MAX_TASKS", 4)
    monkeypatch.setattr(compaction, "MAX_SCANS", 7)
    jobs = []
    write = compaction.write_history
    monkeypatch.setattr(compaction, "write_history", lambda df, *a, **k: (jobs.append(k), write(df, *a, **k)))
    for shuffle, n in ((True, 9), (False, 15)):
        jobs.clear()
        out = f"{folder}/{shuffle}"
        compact(spark, raw, out, CompactionSpec(schema=SCHEMA, rows_per_file=500, shuffle=shuffle))
        assert len(jobs) >= 8
        assert any("maxRecordsPerFile" in k for k in jobs) == shuffle
        assert data(read(spark, out)) == data(read(spark, raw))
    sizes = [sum(1 for _ in open(f)) for f in files_of(f"{folder}/True", "2024-01-01")]
    assert max(sizes) <= 500 and len(sizes) >= 11


def test_whole_files_are_put_together_when_they_are_even():
    fit = compaction._fit
    gb = 1024**3
    assert fit(3, 30, 3 * gb, gb // 10, None) == (3, True)
    assert fit(3, 30, 3 * gb, 25 * gb // 10, None) == (3, False)
    assert fit(3, 30, gb // 2, gb // 60, None) == (3, False)
    assert fit(100, 40, 4 * gb, gb // 10, None) == (40, True)
    assert fit(100, 40, 4 * gb, gb // 10, True) == (100, False)
    assert fit(10, 1, 1000 * compaction.SPLIT_BYTES, 1000 * compaction.SPLIT_BYTES, None) == (10, False)


@pytest.mark.parametrize("mode", ["incremental", "full"])
def test_plans_from_file_sizes_read_the_input_once(spark, raw, folder, mode, monkeypatch):
    monkeypatch.setattr(compaction, "compaction_plan", None)
    monkeypatch.setattr(compaction, "files_for", None)
    sizes = {r[PARTITION_COLUMN]: r["bytes"] for r in list_partitions(spark, raw).collect()}
    out = f"{folder}/out"
    got = compact(spark, raw, out, CompactionSpec(mode=mode, schema=SCHEMA, bytes_per_file=50_000))
    assert got.rows == 15_000
    if mode == "full":
        assert got.files == len(glob.glob(f"{out}/part-*")) == math.ceil(sum(sizes.values()) / 50_000)
    else:
        assert got.files == sum(min(math.ceil(b / 50_000), 4) for b in sizes.values())
        assert data(read(spark, out)) == data(read(spark, raw))


def test_until_lists_only_recent_days(spark, raw, folder, monkeypatch):
    spec = CompactionSpec(schema=SCHEMA)
    compact(spark, raw, folder, spec, until=date(2024, 1, 20))
    assert list_partitions(spark, folder).count() == 20
    listed = []
    real = compaction.list_partitions
    monkeypatch.setattr(compaction, "list_partitions", lambda s, root, *a: (listed.append((root, len(a) > 1)), real(s, root, *a))[1])
    got = compact(spark, raw, folder, spec, until=date(2024, 1, 25))
    assert [d.day for d in got.partitions] == [19, 20, 21, 22, 23, 24, 25]
    assert (raw, False) not in listed
    assert compact(spark, raw, folder, spec, until=date(2024, 1, 1)) == compaction.NOTHING
    assert compact(spark, raw, folder, spec, until=date(2025, 1, 1)).partitions[-1] == date(2024, 1, 30)


def test_an_inferred_schema_holds_for_all_partitions(spark, folder):
    spark.createDataFrame([(1, "x", None, "2024-01-01"), (2, None, 5, "2024-01-02")], f"id int, a string, b int, {PARTITION_COLUMN} string").write.partitionBy(
        PARTITION_COLUMN
    ).json(f"{folder}/in")
    compact(spark, f"{folder}/in", f"{folder}/out", CompactionSpec())
    got = spark.read.json(f"{folder}/out").select("id", "a", "b").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (2, None, 5)]


def test_lines_are_moved_as_they_are(spark, folder):
    os.makedirs(f"{folder}/in/{PARTITION_COLUMN}=2024-01-01")
    lines = ['{"a": 1.50}', "not json", '{"b":  "é"}']
    with open(f"{folder}/in/{PARTITION_COLUMN}=2024-01-01/x.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    spec = CompactionSpec(source_format="text", schema="value STRING")
    assert compact(spark, f"{folder}/in", f"{folder}/out", spec).rows == 3
    assert [r["value"] for r in spark.read.text(f"{folder}/out").select("value").collect()] == lines


def _calendar(spark, root, texts):
    for i, text in enumerate(texts):
        spark.range(i + 1).write.json(f"{root}/{text}")


def test_calendar_directories(spark, folder):
    src, dst = f"{folder}/2020/01/01/src", f"{folder}/dst"
    _calendar(spark, src, ["2023/12/31", "2024/01/02/13", "2024/01/03"])
    assert sorted((str(r[0]), r["files"]) for r in list_calendar(spark, src).select(PARTITION_COLUMN, "files").collect()) == [
        ("2023-12-31", 1),
        ("2024-01-02", 2),
        ("2024-01-03", 3),
    ]
    spec = CompactionSpec(strategy="from_latest", tiers=FIXED_FILES, schema="id BIGINT")
    assert compact_calendar(spark, src, dst, spec).rows == 6
    _calendar(spark, src, ["2024/01/04"])
    again = compact_calendar(spark, src, dst, spec)
    assert [str(p) for p in again.partitions] == ["2024-01-03", "2024-01-04"]
    assert spark.read.json(dst).count() == 7
    one = read_calendar(spark, src, [date(2024, 1, 2)], schema="id BIGINT")
    assert one.count() == 2


def test_files_outside_dated_directories_are_refused(spark, folder):
    spark.range(2).write.json(f"{folder}/src/other")
    _calendar(spark, f"{folder}/src", ["2024/01/04"])
    spec = CompactionSpec(tiers=FIXED_FILES, schema="id BIGINT")
    assert compact_calendar(spark, f"{folder}/src", f"{folder}/dst", spec).rows == 1


def test_listing(spark, raw, folder):
    got = list_partitions(spark, raw)
    assert got.count() == 30 and got.filter("files = 0 OR bytes = 0 OR last_modified IS NULL").isEmpty()
    assert list_partitions(spark, f"{folder}/nothing").isEmpty()
    assert list_files(spark, raw).count() == got.agg(F.sum("files")).first()[0]


def test_partition_scan(spark, raw):
    two = read_partitions(spark, raw, [date(2024, 1, 1), "2024-01-02", "2031-01-01"], schema=SCHEMA)
    assert {str(r[0]) for r in two.select(PARTITION_COLUMN).distinct().collect()} == {"2024-01-01", "2024-01-02"}
    assert len(two.inputFiles()) < 10
    assert read_partitions(spark, raw, ["2031-01-01"], schema=SCHEMA) is None
    assert read_partitions(spark, raw, [], schema=SCHEMA) is None
    assert partition_exists(spark, raw, ["2024-01-02", "2031-01-01"])
    assert not partition_exists(spark, raw, ["2031-01-01"])
    assert has_rows(two) and not has_rows(two.filter("event_id < 0"))


def test_partition_filters_reach_the_scan(spark, raw):
    plan = read_partitions(spark, raw, ["2024-01-01"], schema=SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_capping_never_grows(spark):
    assert cap_partitions(spark.range(0, 10, 1, 4), 2).select(F.spark_partition_id()).distinct().count() == 2
    df = spark.range(10)
    assert cap_partitions(df, None) is df


def test_newest_file_decides_the_schema(spark, folder):
    spark.range(1).write.json(f"{folder}/a")
    time.sleep(1.1)
    spark.range(1).withColumn("extra", F.lit("x")).coalesce(1).write.json(f"{folder}/b")
    assert latest_schema(spark, folder).names == ["extra", "id"]
    assert latest_schema(spark, f"{folder}/none") is None


def test_directories_without_a_date_are_told_and_stop_nothing(spark, folder):
    from lakerecon.sources import list_partitions, list_undated

    for value in ("initial", "__HIVE_DEFAULT_PARTITION__", "2024-01-01"):
        spark.range(2).write.json(f"{folder}/feed/event_creation_time={value}")
    assert [str(r[0]) for r in list_partitions(spark, f"{folder}/feed").collect()] == ["2024-01-01"]
    assert sorted(r["value"] for r in list_undated(spark, f"{folder}/feed").collect()) == ["__HIVE_DEFAULT_PARTITION__", "initial"]
