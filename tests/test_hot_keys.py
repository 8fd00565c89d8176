"""Spread joins give the rows of plain joins, and the spreading does spread."""

from datetime import datetime

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from lakerecon import (
    HotKeys,
    ReconSpec,
    column_diff,
    compare_rows,
    find_hot_keys,
    join_to_unique,
    missing_records,
    publish_recon,
    row_recon,
)
from lakerecon.operators.hotkeys import SALT, replicate, spread


@pytest.fixture(scope="module")
def skewed(spark):
    """A target in which one user holds a third of all rows, many of them copies, and one has no key."""
    events = spark.read.parquet(f"{DATA}/events.parquet")
    user = (
        F.when(F.col("event_type").isin("click"), F.lit(7))
        .when(F.col("event_type") == "view", F.lit(None))
        .when(F.col("event_type") == "error", F.col("user_id") + 1000)
        .otherwise(F.col("user_id"))
    )
    return events.select(user.alias("user_id"), "event_type", F.round("value").alias("value"))


@pytest.fixture(scope="module")
def users(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    return events.groupBy("user_id").agg(F.max("event_type").alias("event_type"), F.max("value").alias("value"))


@pytest.fixture(scope="module")
def hot(skewed):
    return find_hot_keys(skewed, ["user_id"], share=0.05, min_rows=100)


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def test_hot_keys_are_found(spark, skewed, hot):
    wanted = spark.sql("SELECT xxhash64(7L), xxhash64(CAST(NULL AS BIGINT))").first()
    assert set(hot.salts) == set(wanted)
    assert all(n > 50 for n in hot.salts.values())
    assert not find_hot_keys(skewed, ["user_id"])
    assert not find_hot_keys(skewed.limit(0), ["user_id"], share=0.05, min_rows=1)


def test_rows_of_a_hot_key_are_spread_evenly(spark, skewed, hot):
    salted = spread(skewed.repartition(16), hot).filter("user_id = 7")
    sizes = [r["count"] for r in salted.groupBy(SALT).count().collect()]
    assert len(sizes) > 50 and max(sizes) < 0.1 * sum(sizes)
    cold = spread(skewed, hot).filter("user_id <> 7").select(SALT).distinct().collect()
    assert [r[0] for r in cold] == [0]


def test_copies_match_the_salts(users, hot):
    assert replicate(users, hot).filter("user_id = 7").count() == max(hot.salts.values()) or len(hot.salts) == 2
    assert replicate(users, hot).filter("user_id <> 7").count() == users.filter("user_id <> 7").count()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, users, hot, how):
    right = users.withColumnsRenamed({"event_type": "last_type", "value": "top"})
    assert rows(join_to_unique(skewed, right, ["user_id"], how, hot)) == rows(skewed.join(right, ["user_id"], how))


def test_spread_refuses_joins_it_cannot_do(skewed, users, hot):
    with pytest.raises(ValueError):
        join_to_unique(skewed, users, ["user_id"], "full_outer", hot)


def test_missing_records_of_hot_sources(skewed, users, hot):
    some = users.filter("user_id <= 70")
    assert rows(missing_records(skewed, some, ["user_id"], hot=hot)) == rows(missing_records(skewed, some, ["user_id"], hot=None))


@pytest.mark.parametrize("null_safe", [True, False])
def test_comparison_with_hot_target_keys(skewed, users, hot, null_safe):
    args = (["user_id"], ["event_type", "value"], null_safe)
    plain, salted = (compare_rows(users, skewed, *args, hot=h) for h in (None, hot))
    assert rows(plain) == rows(salted)
    assert rows(column_diff(plain, *args)) == rows(column_diff(salted, *args))
    assert plain.filter("present_in = 'source'").count() + plain.filter("present_in = 'target'").count() > 0


def test_composite_keys(skewed):
    hot = find_hot_keys(skewed, ["user_id", "event_type"], share=0.05, min_rows=100)
    right = skewed.filter("event_type <> 'click'").select("user_id", "event_type").distinct()
    assert isinstance(hot, HotKeys) and hot
    got, want = (join_to_unique(skewed, right, ["user_id", "event_type"], "left_anti", h) for h in (hot, None))
    assert rows(got) == rows(want)


def test_reconciliation_with_hot_target_keys(spark, skewed, users, hot, folder):
    at = F.lit("2024-01-15 10:00:00").cast("timestamp_ntz")
    source, target = (df.withColumn("at", at) for df in (users.unionAll(users), skewed))
    fields = ["at", "event_type", "value"]
    spec = ReconSpec("t", ["user_id"], fields, fields)
    plain, salted = (row_recon(source, target, spec, datetime(2024, 1, 15, 12), hot=h) for h in (None, hot))
    assert plain.summary.collect() == salted.summary.collect()
    assert plain.summary.first()["target_row_count"] == 10_000
    one, other = (publish_recon(r, f"{folder}/{i}") for i, r in enumerate((plain, salted)))
    assert one.counts == other.counts
    assert rows(one.exceptions) == rows(other.exceptions)


def test_columns_without_a_hash_are_left_out_of_the_salt(spark, skewed, users, hot):
    left = skewed.withColumn("m", F.create_map("event_type", "value"))
    right = users.select("user_id", F.col("value").alias("top"))
    assert join_to_unique(left, right, ["user_id"], "left", hot).count() == left.count()


@pytest.mark.parametrize("one, other", [("int", "bigint"), ("bigint", "smallint"), ("decimal(10,2)", "decimal(12,4)"), ("date", "timestamp_ntz"), ("int", "double")])
def test_keys_of_two_types_are_salted_alike(spark, one, other):
    value = "date_add(DATE'2024-01-01', CAST(id % 7 AS INT))" if one == "date" else "id % 7"
    source = spark.range(700).selectExpr(f"CAST({value} AS {one}) AS k", "id AS v")
    target = spark.range(5).selectExpr(f"CAST({value} AS {other}) AS k", "id AS v")
    hot = find_hot_keys(source, ["k"], share=0.05, min_rows=50)
    assert len(hot.salts) == 7
    for how in (dict(hot=hot), dict(hot=hot, null_safe=True)):
        assert rows(missing_records(source, target, ["k"], **how)) == rows(missing_records(source, target, ["k"], hot=None))
        assert missing_records(source, target, ["k"], **how).count() == 200
    salted, plain = (compare_rows(target, source, ["k"], ["v"], hot=h) for h in (find_hot_keys(source, ["k"], 0.05, 50), None))
    assert rows(salted) == rows(plain)


def test_given_hot_keys_are_used_with_equal_nulls(spark, skewed, users, hot):
    plan = missing_records(skewed, users, ["user_id"], hot=hot, null_safe=True)._jdf.queryExecution().toString()
    assert SALT in plan
    with pytest.raises(ValueError):
        missing_records(skewed.withColumn("user_id", F.col("user_id").cast("string")), users, ["user_id"])
