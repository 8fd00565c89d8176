"""Bitmaps of keys against sets."""

import random

import pytest
from pyspark.sql import functions as F

from lakerecon import bitmap_cost, count_keys, key_bitmaps, merge_bitmaps, missing_keys, missing_records, missing_records_bitmap
from lakerecon.operators import bitmaps


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(8)
    edges = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, 65537, -65536, 2**62, -(2**62), 2**31 - 1]
    source = [rng.randrange(-70_000, 140_000) for _ in range(4000)] + edges + [None, None, 5, 5]
    target = [k for k in source if k is None or rng.random() < 0.9] + [10**9, 7, None]
    make = lambda keys: spark.createDataFrame([(k, f"v{i % 3}") for i, k in enumerate(keys)], "k long, v string").repartition(4)
    return make(source), make(target), source, target


def test_missing_keys_are_those_of_sets(sides):
    source, target, mine, other = sides
    got = [r.k for r in missing_keys(source, target, "k").collect()]
    assert len(got) == len(set(got)) and set(got) == {*mine} - {*other} - {None}
    assert missing_keys(source, source, "k").collect() == [] and missing_keys(source.limit(0), target, "k").collect() == []
    assert {r.k for r in missing_keys(source, target.limit(0), "k").collect()} == {*mine} - {None}


@pytest.mark.parametrize("most", [16_384, 2])
def test_missing_records_are_the_same(sides, monkeypatch, most):
    monkeypatch.setattr(bitmaps, "MAX_BROADCAST", most)
    source, target, *_ = sides
    wanted = sorted(map(repr, missing_records(source, target, ["k"], hot=None).collect()))
    assert sorted(map(repr, missing_records_bitmap(source, target, "k").collect())) == wanted and len(wanted) > 100


def test_rows_are_not_shuffled(sides):
    source, target, *_ = sides
    plan = missing_records_bitmap(source, target, "k")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in above and "BroadcastHashJoin" in above


def test_counts_are_exact_and_bitmaps_add_up(sides):
    source, target, mine, other = sides
    assert count_keys(key_bitmaps(source, "k")).first()["keys"] == len({*mine} - {None})
    both = merge_bitmaps(key_bitmaps(source, "k").unionAll(key_bitmaps(target, "k")))
    assert count_keys(both).first()["keys"] == len({*mine, *other} - {None})
    assert count_keys(key_bitmaps(source.limit(0), "k")).first()["keys"] == 0


def test_types_and_cost(spark, sides):
    small = spark.createDataFrame([(i,) for i in range(-5, 300)], "k int")
    assert missing_keys(small, small.filter("k % 7 != 0"), "k").schema["k"].dataType.simpleString() == "int"
    assert missing_keys(small, small.filter("k % 7 != 0"), "k").count() == sum(k % 7 == 0 for k in range(-5, 300))
    near, far = spark.range(1, 100_001), spark.range(1, 1001).select((F.col("id") * 10**9).alias("id"))
    assert bitmap_cost(near, "id") < 0.2 and bitmap_cost(far, "id") > 3000 and bitmap_cost(near.limit(0), "id") == 0
    with pytest.raises(ValueError):
        key_bitmaps(small.select(F.col("k").cast("string").alias("k")), "k")
