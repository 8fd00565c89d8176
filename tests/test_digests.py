"""Digests of key buckets, tables kept by them, and what is read and shuffled for a comparison."""

import random

import pytest
from pyspark.sql import functions as F

from lakerecon import BucketedTable, compare_rows, latest_per_key, recon_by_digest, recon_tables
from lakerecon.operators.digest import differing_buckets, differing_leaves, leaf_digests, parent_digests, with_leaf

SCHEMA = "k long, part string, a int, b double, c array<string>"


def rows(seed=1, n=300):
    rng = random.Random(seed)
    made = [(i, rng.choice(["x", "y"]), rng.choice([None, 1, 2]), rng.choice([None, 0.5]), rng.choice([None, ["p", None], ["p"]])) for i in range(n)]
    return made + [(None, "x", 1, 1.0, None), (7000, None, 1, 1.0, [])]


@pytest.fixture(scope="module")
def sides(spark):
    source, changed = rows(), []
    for i, r in enumerate(source):
        if i % 50 == 1:
            continue
        changed.append((r[0], r[1], None if r[2] and i % 60 == 3 else r[2], r[3], [None, "p"] if i == 100 else r[4]))
    changed += [(9000, "x", 1, 2.0, None), changed[10], changed[10], changed[20][:2] + (5, None, None)]
    return spark.createDataFrame(source, SCHEMA).repartition(4), spark.createDataFrame(changed, SCHEMA).repartition(3)


def flat(df):
    return sorted(map(repr, df.select("k", "part", "_src", "_tgt", "present_in", "is_mismatch").collect()))


@pytest.mark.parametrize("null_safe", [True, False])
@pytest.mark.parametrize(("buckets", "leaves"), [(4096, 256), (3, 2), (1, 1)])
def test_exceptions_are_those_of_the_full_comparison(sides, buckets, leaves, null_safe):
    keys, columns = ["k", "part"], ["a", "b", "c"]
    whole = compare_rows(*sides, keys, columns, null_safe, hot=None).filter((F.col("present_in") != "both") | F.col("is_mismatch"))
    found = recon_by_digest(*sides, keys, columns, null_safe, buckets=buckets, leaves=leaves)
    assert flat(found.exceptions) == flat(whole) and whole.count() > 10
    assert found.counts == {"source_row_count": sides[0].count(), "target_row_count": sides[1].count()}


def test_equal_sides_open_nothing_but_null_keys(sides):
    source = sides[0]
    found = recon_by_digest(source, source.repartition(7), ["k", "part"], ["a", "b", "c"])
    assert found.buckets == (-1,)
    assert sorted(r.present_in for r in found.exceptions.collect()) == ["source", "source", "target", "target"]
    assert recon_by_digest(source.limit(0), source.limit(0), ["k"], ["a"]).exceptions.collect() == []


def test_numbers_of_two_types_agree(spark):
    left = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    right = spark.createDataFrame([(1, 5.0), (2, 6.5)], "k long, v double")
    found = recon_by_digest(left, right, ["k"], ["v"])
    assert len(found.buckets) == 1 and [r.k for r in found.exceptions.collect()] == [2]
    with pytest.raises(ValueError):
        recon_by_digest(left, right.withColumn("k", F.col("k").cast("string")), ["k"], ["v"])
    with pytest.raises(ValueError):
        recon_by_digest(left.withColumn("m", F.create_map("k", "v")), left.withColumn("m", F.create_map("k", "v")), ["k"], ["m"])
    with pytest.raises(ValueError):
        with_leaf(left.withColumnRenamed("v", "key_leaf"), ["k"])


def test_digests_tell_null_from_null_and_copies_apart(spark):
    def digest(*values):
        df = spark.createDataFrame([(1, *v) for v in values], "k int, a int, b int, c array<int>")
        return [tuple(r) for r in leaf_digests(with_leaf(df, ["k"]), ["k", "a", "b", "c"]).collect()]

    one, other = (None, 1, None), (1, None, None)
    assert digest(one) != digest(other)
    assert digest(one, other) == digest(other, one)
    assert digest(one, other, other) != digest(one, one, other) != digest(one, one, one)
    assert digest((1, 1, [None, 2])) != digest((1, 1, [2, None])) and digest((1, 1, [None])) != digest((1, 1, []))


def test_parents_add_up(sides):
    leafed = with_leaf(sides[0], ["k"], 8, 4)
    leaves = leaf_digests(leafed, ["k", "a"])
    by_bucket = parent_digests(leaves, ["key_bucket"])
    root = parent_digests(by_bucket, []).first()
    assert root.n == sides[0].count() and root == parent_digests(leaves, []).first()
    assert differing_buckets(leaves, leaves) == [-1] and differing_leaves(leaves, leaves.filter("key_bucket != 3"), [3]).agg(F.sum("left_rows")).first()[0] == (
        leafed.filter("key_bucket = 3").count()
    )


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def latest(df):
    return sorted(map(repr, latest_per_key(df, ["k"], ["at"]).select("k", "at", "v").collect()))


def test_state_is_the_ranking_over_all_increments(spark, folder):
    rng = random.Random(6)
    made = [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice([None, "p", "q"])) for _ in range(400)]
    whole = spark.createDataFrame(made, "k int, at int, v string")
    table = BucketedTable(spark, f"{folder}/t", ["k"], ["v"], buckets=8, leaves=4, files=2)
    assert table.rows() is None and table.digests().collect() == [] and table.upsert(whole.limit(0), ["at"]) == []
    parts = [whole.filter(F.pmod(F.hash("k", "at", "v"), F.lit(3)) == i) for i in range(3)]
    for part in (parts[2], parts[0], parts[0].unionAll(parts[1]), parts[2]):
        table.upsert(part, ["at"])
    kept = table.rows()
    assert sorted(map(repr, kept.select("k", "at", "v").collect())) == latest(whole)
    assert sorted(map(tuple, table.digests().collect())) == sorted(map(tuple, leaf_digests(kept, ["k", "v"]).collect()))
    untouched = files(kept.filter("key_bucket != 5"))
    one = kept.filter("key_bucket = 5").select("k").first().k
    assert table.upsert(spark.createDataFrame([(one, 99, "new")], whole.schema), ["at"]) == [5]
    after = table.rows()
    assert untouched <= files(after) and after.filter(F.col("k") == one).select("at", "v").collect() == [(99, "new")]


def test_only_buckets_that_differ_are_read(spark, folder, sides):
    keys, columns = ["k", "part"], ["a", "b", "c"]
    whole = sides[0].filter("k IS NOT NULL AND part IS NOT NULL")
    source, target = (BucketedTable(spark, f"{folder}/{name}", keys, columns, buckets=16, leaves=8) for name in ("s", "t"))
    source.replace(whole)
    target.replace(whole.filter("k != 5").withColumn("a", F.when(F.col("k") == 6, -1).otherwise(F.col("a"))))
    found = recon_tables(source, target)
    wanted = {r.key_bucket for r in with_leaf(whole.filter("k IN (5, 6)"), keys, 16).select("key_bucket").collect()}
    assert set(found.buckets) == wanted
    assert sorted((r.k, r.present_in) for r in found.exceptions.collect()) == [(5, "source"), (6, "both")]
    read = {int(f.split("key_bucket=")[1].split("/")[0]) for f in files(source.rows(found.buckets))}
    assert read == wanted
    plan = found.exceptions._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "key_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError):
        recon_tables(source, BucketedTable(spark, f"{folder}/u", keys, columns, buckets=8))


def test_unfinished_buckets_are_looked_at_again(spark, folder, sides):
    keys, columns = ["k", "part"], ["a", "b", "c"]
    source, target = (BucketedTable(spark, f"{folder}/{name}", keys, columns, buckets=4, leaves=8) for name in ("s", "t"))
    source.replace(sides[0])
    target.replace(sides[0])
    before = sorted(map(tuple, target.digests().collect()))
    fields = "key_leaf int, n long, high long, low long, mixed long, key_bucket int"
    mark = spark.createDataFrame([(0, None, None, None, None, 2)], fields)
    mark.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("key_bucket").parquet(target.digests_path)
    assert sorted(map(tuple, target.digests().collect())) == before
    assert recon_tables(source, target).buckets == (-1,)
    empty = BucketedTable(spark, f"{folder}/e", keys, columns, buckets=4, leaves=8)
    assert recon_tables(source, empty).exceptions.count() == sides[0].count()
    with pytest.raises(ValueError):
        recon_tables(empty, empty)
