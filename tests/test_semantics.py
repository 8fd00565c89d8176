"""Hand-written rows for the decisions about nulls, ties, casts, windows and text."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakerecon import (
    AuditStamp,
    DQRule,
    ReconSpec,
    align_names,
    align_types,
    as_local_timestamp,
    column_diff,
    compare_rows,
    count_recon,
    diff_text,
    eastern_text,
    eastern_time,
    extract_keys,
    landing_stats,
    latest_per_key,
    missing_records,
    normalise_ts,
    project_exprs,
    read_increment,
    recon_dates,
    redact,
    row_recon,
    rows_as_json,
    rule_summary,
    run_rules,
    split_payload,
    timestamps_as_text,
    within_window,
)

from lakerecon.sinks.audit import audit_rows
from lakerecon.sources.increments import read_up_to


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_latest_breaks_ties_by_the_remaining_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "x"), (2, None, "y"), (None, 1, "n")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 5, "b"), (2, 1, "x"), (None, 1, "n")]


def test_latest_ignores_columns_that_cannot_be_ordered(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"a": 2})], "k int, t int, m map<string,int>")
    assert rows(latest_per_key(df, ["k"], ["t"])) == [(1, 2, {"a": 2})]


def test_null_keys_are_missing_unless_null_safe(spark):
    src = spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "k int, v int")
    tgt = spark.createDataFrame([(1, 9), (None, 9)], "k int, w int")
    assert rows(missing_records(src, tgt, ["k"])) == [(2, 1), (None, 1)]
    assert rows(missing_records(src, tgt, ["k"], null_safe=True)) == [(2, 1)]


def test_nothing_is_missing_from_itself(spark):
    df = spark.range(100)
    assert missing_records(df, df, ["id"]).isEmpty()


SRC = [(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0), (4, "d", 4.0), (None, "n", 0.0)]
TGT = [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.5), (5, "e", 5.0), (None, "n", 0.0)]


def _pair(spark):
    schema = "k int, name string, x double"
    return spark.createDataFrame(SRC, schema), spark.createDataFrame(TGT, schema)


def test_one_sided_rows_are_not_mismatches(spark):
    got = compare_rows(*_pair(spark), ["k"], ["name", "x"]).select("k", "present_in", "is_mismatch")
    assert rows(got) == sorted(
        [
            (1, "both", False),
            (2, "both", True),
            (3, "both", True),
            (4, "source", False),
            (5, "target", False),
            (None, "source", False),
            (None, "target", False),
        ],
        key=repr,
    )


def test_null_against_value_differs_only_when_null_safe(spark):
    keys, columns = ["k"], ["name", "x"]
    safe = compare_rows(*_pair(spark), keys, columns)
    assert rows(column_diff(safe, keys, columns)) == [(2, "name", None, "b"), (3, "x", "3.0", "3.5")]
    literal = compare_rows(*_pair(spark), keys, columns, null_safe=False)
    text = diff_text(literal, keys, columns, "t", date(2024, 1, 15))
    assert rows(text) == [("x src1 3.0 tgt1 3.5", 3, "t", "k", "3", "2024-01-15")]


def test_a_frame_does_not_differ_from_itself(spark):
    src, _ = _pair(spark)
    assert column_diff(compare_rows(src, src, ["k"], ["name", "x"]), ["k"], ["name", "x"]).isEmpty()


def test_target_rows_with_the_same_key_are_all_compared(spark):
    src = spark.createDataFrame([(1, 1)], "k int, v int")
    tgt = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "k int, v int")
    assert rows(column_diff(compare_rows(src, tgt, ["k"], ["v"]), ["k"], ["v"])) == [(1, "v", "1", "2"), (1, "v", "1", "3")]


def test_uncastable_values_become_null_and_are_counted(spark):
    df = spark.createDataFrame([("1", "x"), ("oops", "y"), (None, "z")], "k string, v string")
    ref = spark.createDataFrame([(1, "x")], "k int, v string")
    assert rows(align_types(df, ref, ["k", "v"], lost="lost")) == [(1, "x", 0), (None, "y", 1), (None, "z", 0)]


def test_timestamps_are_compared_as_moments(spark):
    df = spark.createDataFrame([("2024-01-15T10:00:03.120",), ("2024-01-15 10:00:03.12",), ("never",)], "ts string")
    same = datetime(2024, 1, 15, 10, 0, 3, 120000)
    assert rows(normalise_ts(df, ["ts"])) == sorted([(same,), (same,), (None,)], key=repr)


def test_columns_called_timestamp_become_text(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-15 10:00:00' AS Timestamp, 1 AS n")
    assert timestamps_as_text(df).dtypes == [("Timestamp", "string"), ("n", "int")]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string"])
def test_window_is_half_open(spark, kind):
    as_of = datetime(2024, 1, 15, 12)
    texts = ["2024-01-14 11:59:59.999999", "2024-01-14 12:00:00", "2024-01-15 11:59:59.999999", "2024-01-15 12:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("t", F.col("t").cast(kind))
    assert [r["i"] for r in within_window(df, "t", as_of).collect()] == [1, 2]


def test_recon_dates_cover_the_window():
    assert recon_dates(datetime(2024, 1, 15, 12)) == [date(2024, 1, 14), date(2024, 1, 15)]
    assert recon_dates(datetime(2024, 1, 15)) == [date(2024, 1, 14)]


def test_projection_keeps_the_given_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, k int")
    out = project_exprs(df, ["k"], ["b", "a"], {"a": "a * 10", "extra": "b + k"})
    assert out.columns == ["k", "b", "a", "extra"] and rows(out) == [(3, 2, 10, 5)]
    assert align_names(df, ["k"], ["x", "y"], ["b", "a"]).columns == ["k", "x", "y"]
    with pytest.raises(ValueError):
        align_names(df, ["k"], ["x"], ["b", "a"])


def test_count_recon_one_sided_groups_fail_with_null_difference(spark):
    left = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3), (None, 1)], "g string, left_count int")
    right = spark.createDataFrame([("a", 2), ("c", 1), ("d", 4), (None, 1)], "g string, right_count int")
    got = count_recon(left, right, ["g"], "ctl", "t").select("g", "differences", "run_status", "present_in")
    assert rows(got) == sorted(
        [
            ("a", 0, "success", "both"),
            ("b", None, "Failure", "left"),
            ("c", 2, "Failure", "both"),
            ("d", None, "Failure", "right"),
            (None, None, "Failure", "left"),
            (None, None, "Failure", "right"),
        ],
        key=repr,
    )
    safe = count_recon(left, right, ["g"], "ctl", "t", null_safe=True).filter("g is null")
    assert rows(safe.select("differences", "run_status")) == [(0, "success")]


def test_count_recon_composite_keys_are_prefixed(spark):
    left = spark.createDataFrame([("a", 1, 5), ("b", None, 5)], "left_x string, left_y int, left_count int")
    right = spark.createDataFrame([("a", 1, 5), ("b", None, 5)], "right_x string, right_y int, right_count int")
    plain = count_recon(left, right, ["x", "y"], "ctl", "t")
    assert plain.columns[:6] == ["left_x", "left_y", "left_count", "right_x", "right_y", "right_count"]
    assert plain.filter("run_status = 'success'").count() == 1
    assert count_recon(left, right, ["x", "y"], "ctl", "t", null_safe=True).filter("run_status = 'success'").count() == 2


def test_row_recon_matches_rows_written_out(spark):
    src = spark.createDataFrame(
        [
            ("1", "2024-01-15T01:00:00", "old"),
            ("1", "2024-01-15T02:00:00", "new"),
            ("2", "2024-01-15T03:00:00.120", "same"),
            ("3", "2024-01-15T04:00:00", "gone"),
            ("4", "2024-01-13T04:00:00", "too old"),
            ("x", "2024-01-15T05:00:00", "bad key"),
        ],
        "id string, at string, name string",
    )
    tgt = spark.createDataFrame(
        [(1, datetime(2024, 1, 15, 2), "newer"), (2, datetime(2024, 1, 15, 3, 0, 0, 120000), "same"), (9, datetime(2024, 1, 15, 6), "extra")],
        "id int, event_ts timestamp_ntz, label string",
    )
    spec = ReconSpec("t", ["id"], ["at", "name"], ["event_ts", "label"], timestamps=["at"])
    got = row_recon(src, tgt, spec, datetime(2024, 1, 15, 12))
    assert rows(got.missing.select("id", "name")) == [(3, "gone"), (None, "bad key")]
    assert rows(got.differences) == [(1, "name", "new", "newer")]
    summary = got.summary.first().asDict()
    assert summary == {
        "table_name": "t",
        "source_record_count": 5,
        "source_row_count": 4,
        "target_row_count": 3,
        "difference_total_row_count": 1,
        "source_column_count": 3,
        "target_column_count": 3,
        "difference_total_column_count": 0,
        "missing_record_count": 2,
        "mismatched_record_count": 1,
    }


def test_summary_of_empty_sides(spark):
    empty = spark.createDataFrame([], "id int, at timestamp_ntz, v int")
    spec = ReconSpec("t", ["id"], ["at", "v"], ["at", "v"])
    summary = row_recon(empty, empty, spec, datetime(2024, 1, 15, 12)).summary.first()
    assert (summary["source_record_count"], summary["target_row_count"], summary["missing_record_count"]) == (0, 0, 0)


def test_specs_are_checked():
    with pytest.raises(ValueError):
        ReconSpec("t", [], ["a"], ["a"])
    with pytest.raises(ValueError):
        ReconSpec("t", ["k"], ["a"], ["a", "b"])
    with pytest.raises(ValueError):
        DQRule("r", "select 1", [])


def test_payload_split_keeps_every_row_once(spark):
    df = spark.createDataFrame(
        [(1, '{"k": 1}'), (2, '{"k": 2'), (3, None), (4, '{"k": "text"}'), (5, "{}"), (6, "")], "i int, p string"
    )
    good, bad = split_payload(df, "p", "k BIGINT")
    assert [r["i"] for r in good.orderBy("i").collect()] == [1, 5]
    assert [(r["i"], r["p"]) for r in bad.orderBy("i").collect()] == [(2, '{"k": 2'), (3, None), (4, '{"k": "text"}'), (6, "")]


def test_keys_of_nested_payloads(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "c": "x"}',), ("broken",), (None,)], "p string")
    got = extract_keys(df, "p", {"$.a.b": "list", "$.c": "c"}).drop("p")
    assert rows(got) == sorted([("[1,2]", "x"), (None, None), (None, None)], key=repr)


def test_rows_as_json_leaves_nulls_out(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert rows_as_json(df).first()[0] == '{"a":1}'
    assert rows_as_json(df, keep_nulls=True).first()[0] == '{"a":1,"b":null}'


def test_redaction_follows_the_given_order(spark):
    df = spark.createDataFrame([("connect db.host:5432/db failed",)], "m string")
    assert redact(df, "m", ["db.host", "5432", "db", ""]).first()[0] == "connect ***:***/*** failed"


def test_eastern_times(spark):
    at = F.lit(datetime(2024, 7, 1, 12, 30, 15, 999999)).cast("timestamp")
    row = spark.range(1).select(eastern_time(at).cast("string"), eastern_text(at)).first()
    assert tuple(row) == ("2024-07-01 08:30:15", "2024-07-01T08:30:15.999999Z")


def test_rules_report_violations_and_passes(spark):
    t = spark.createDataFrame([(1, -5), (2, 5)], "id int, v int")
    rules = [DQRule("negative", "SELECT * FROM {t} WHERE v < :limit", ["id"]), DQRule("huge", "SELECT * FROM {t} WHERE v > 100", ["id"])]
    failures = run_rules(spark, rules, AuditStamp("r", datetime(2024, 1, 1)), {"t": t}, {"limit": 0})
    assert [(r["rule_name"], r["record"]) for r in failures.collect()] == [("negative", '{"id":1}')]
    assert rows(rule_summary(failures, rules)) == [("huge", 0, "passed"), ("negative", 1, "failed")]


def test_landing_stats_total_of_nothing(spark):
    empty = spark.createDataFrame([], "a struct<b:string>")
    assert rows(landing_stats(empty, ["a.b"])) == []


def test_null_groups_are_told_from_the_total(spark):
    df = spark.createDataFrame([(None,), (None,), ("x",)], "g string")
    assert rows(landing_stats(df, ["g"], total=True)) == [("x", False, 1), (None, False, 2), (None, True, 3)]


def test_timestamp_columns_are_left_as_they_are(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-15 10:00:00' AS t")
    assert df.select(as_local_timestamp(F.col("t"), df.schema["t"].dataType)).dtypes[0][1] == "timestamp_ntz"


@pytest.fixture(params=["America/New_York", "Asia/Tokyo"])
def elsewhere(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_results_do_not_depend_on_the_session_zone(spark, elsewhere):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-15 11:59:59' AS n, TIMESTAMP '2024-01-15 11:59:59' AS z, '2024-01-15T11:59:59' AS s")
    for column in df.columns:
        assert within_window(df, column, datetime(2024, 1, 15, 12)).count() == 1
        assert within_window(df, column, datetime(2024, 1, 15, 11, 59, 59)).count() == 0
    for column in ("n", "z"):
        mark = df.select(column).first()
        assert read_increment(df, [column], mark).isEmpty()
        assert read_up_to(df, [column], mark).count() == 1
    stamp = AuditStamp("r", datetime(2024, 7, 1, 12, 0, 0, 250000))
    audited = audit_rows(df.select("s"), stamp).select(F.col("run_time").cast("string")).first()[0]
    assert audited == "2024-07-01 08:00:00"
    t = spark.createDataFrame([(1,)], "id int")
    row = run_rules(spark, [DQRule("r", "SELECT * FROM {t}", ["id"])], stamp, {"t": t}).first()
    assert (row["job_run_time"], row["job_run_time_est"]) == ("2024-07-01T12:00:00.250000Z", "2024-07-01T08:00:00.250000Z")


def test_landing_stats_of_columns_that_end_alike(spark):
    df = spark.createDataFrame([(("x",), ("y",))], "a struct<n: string>, b struct<n: string>")
    assert rows(landing_stats(df, ["a.n", "b.n"])) == [("x", "y", 1)]
    assert landing_stats(df, ["a.n", "b.n"]).columns == ["a_n", "b_n", "rows"]
