"""Drill-down by counts, runs from paths, audit fields, and records whose key does not fit."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakerecon import PARTITION_COLUMN, AuditStamp, CountReconSpec, ReconSpec, drill_counts, publish_count_control, publish_recon, recon_run, row_recon
from lakerecon.operators import counts


@pytest.fixture(scope="module")
def sides(spark):
    left = [("a", 1, i) for i in range(5)] + [("a", 2, 0), ("b", 1, 0), (None, 1, 0), (None, None, 0), ("d", 1, 0)]
    right = [("a", 1, i) for i in range(4)] + [("a", 2, 0), ("b", 2, 0), (None, 1, 0), ("c", 1, 0), ("d", 1, 0)]
    return tuple(spark.createDataFrame(rows, "g string, h int, i int") for rows in (left, right))


@pytest.mark.parametrize(("most_open", "most_pushed"), [(100_000, 1_000), (100_000, 1), (0, 0)])
def test_only_differing_groups_are_opened(sides, monkeypatch, most_open, most_pushed):
    monkeypatch.setattr(counts, "MAX_OPEN", most_open)
    monkeypatch.setattr(counts, "MAX_PUSHED", most_pushed)
    got = {(r.level, r.g, r.h): (r.left_count, r.right_count, r.run_status, r.present_in) for r in drill_counts(*sides, ["g", "h"], "c", "t").collect()}
    assert got == {
        (0, None, None): (10, 9, "Failure", "both"),
        (1, "a", None): (6, 5, "Failure", "both"),
        (1, "b", None): (1, 1, "success", "both"),  # its hours cancel out
        (1, None, None): (2, 1, "Failure", "both"),
        (1, "c", None): (0, 1, "Failure", "right"),
        (1, "d", None): (1, 1, "success", "both"),
        (2, "a", 1): (5, 4, "Failure", "both"),
        (2, "a", 2): (1, 1, "success", "both"),
        (2, None, 1): (1, 1, "success", "both"),
        (2, None, None): (1, 0, "Failure", "left"),
        (2, "c", 1): (0, 1, "Failure", "right"),
    }


def test_equal_and_empty_sides_end_at_the_first_column(sides):
    left, _ = sides
    assert sorted((r.level, r.run_status) for r in drill_counts(left, left, ["g", "h"], "c", "t").collect()) == [(0, "success")] + [(1, "success")] * 4
    none = drill_counts(left.limit(0), left.limit(0), ["g"], "c", "t").collect()
    assert [(r.left_count, r.present_in) for r in none] == [(0, "neither")]
    one = drill_counts(left, left.limit(0), ["g"], "c", "t")
    assert {r.present_in for r in one.collect()} == {"left"} and one.count() == 5


def test_later_levels_read_differing_directories_only(spark, folder, sides):
    for name, side in zip("lr", sides):
        side.filter("g IS NOT NULL").write.partitionBy("g").parquet(f"{folder}/{name}")
    left, right = (spark.read.parquet(f"{folder}/{name}") for name in "lr")
    opened = counts._opened(left, spark.createDataFrame([("a",), ("c",)], "g string"), ["g"])
    assert {f.split("g=")[1][0] for f in {r[0] for r in opened.select(F.input_file_name()).distinct().collect()}} == {"a"}
    assert "PartitionFilters: [isnotnull(g" in (plan := opened._jdf.queryExecution().executedPlan().toString()) or "g#" in plan.split("PartitionFilters")[1][:40]
    assert drill_counts(left, right, ["g", "h"], "c", "t").filter("level = 2").count() == 3  # two hours of a, one of c


SPEC = ReconSpec("t", ["k"], ["at", "v"], ["at", "v"], timestamps=["at"])
AS_OF = datetime(2024, 1, 2, 12)


def test_records_with_keys_that_do_not_fit_are_counted_one_by_one(spark, folder):
    at = datetime(2024, 1, 2)
    source = [("1", at, "x"), ("1", at, "y"), ("01", at, "x"), ("2", at, "z"), ("bad", at, "x"), ("bad", at, "y"), ("worse", at, "x"), (None, at, "x"), (None, at, "y")]
    source = spark.createDataFrame(source, "k string, at timestamp_ntz, v string")
    target = spark.createDataFrame([(1, at, "y"), (2, at, "other")], "k int, at timestamp_ntz, v string")
    recon = row_recon(source, target, SPEC, AS_OF)
    summary = recon.summary.first()
    # keys 1 and 2, three records that do not fit, one null key
    assert (summary.source_record_count, summary.source_row_count, recon.latest.count()) == (9, 6, 6)
    assert (summary.missing_record_count, summary.mismatched_record_count) == (4, 1)
    done = publish_recon(recon, f"{folder}/x")
    assert (done.counts["source_record_count"], done.counts["source_row_count"]) == (9, 6)


def test_a_run_ends_where_no_directory_is(spark, folder):
    rows = [(1, "2024-01-02 01:00:00", "x", "2024-01-02"), (2, "2024-01-01 13:00:00", "y", "2024-01-01"), (3, "2024-01-01 01:00:00", "early", "2024-01-01")]
    spark.createDataFrame(rows, f"k int, at string, v string, {PARTITION_COLUMN} string").write.partitionBy(PARTITION_COLUMN).json(f"{folder}/in")
    target = spark.createDataFrame([(1, datetime(2024, 1, 2, 1), "other")], "k int, at timestamp_ntz, v string")
    done = recon_run(spark, f"{folder}/in", target, SPEC, AS_OF, f"{folder}/out", schema="k int, at timestamp_ntz, v string")
    assert done.exported == 1 and done.published.counts["mismatched_record_count"] == 1 and done.published.counts["source_record_count"] == 2
    assert [r.k for r in spark.read.option("header", "true").csv(f"{folder}/out/missing").collect()] == ["2"]
    half = recon_run(spark, f"{folder}/in", target, SPEC, datetime(2024, 1, 3, 1), f"{folder}/half", schema="k int, at timestamp_ntz, v string")
    assert len(half.dates) == 2 and half.published.counts["source_record_count"] == 1
    for as_of, root in ((datetime(2031, 1, 1), f"{folder}/in"), (AS_OF, f"{folder}/nowhere")):
        none = recon_run(spark, root, target, SPEC, as_of, f"{folder}/none")
        assert none.published is None and none.exported == 0 and none.dates


def test_audit_fields_reach_table_and_alerts(spark, folder):
    views = {"x": spark.createDataFrame([("a", 3), ("b", 1)], "g string, left_count long"), "y": spark.createDataFrame([("a", 3)], "g string, right_count long")}
    stamp = AuditStamp("run", datetime(2024, 1, 1))
    spark.sql(f"CREATE TABLE audit_fields_t (g STRING, status STRING, run_time TIMESTAMP_NTZ, run_id STRING) USING parquet LOCATION '{folder}/a'")
    spec = CountReconSpec("c", "t", "SELECT * FROM {x}", "SELECT * FROM {y}", ["g"], audit_fields=["g", "upper(run_status) AS status"])
    alerts = publish_count_control(spark, spec, "audit_fields_t", stamp, views)
    assert sorted((r.g, r.status, r.run_id) for r in spark.table("audit_fields_t").collect()) == [("a", "SUCCESS", "run"), ("b", "FAILURE", "run")]
    texts = sorted(r.alert for r in alerts.collect())
    assert len(texts) == 2 and '"g":"b","status":"FAILURE"' in texts[1] and '"differences":0' in texts[0]
    spark.sql("DROP TABLE audit_fields_t")
