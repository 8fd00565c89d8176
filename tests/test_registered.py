"""Compaction with registered schemas, and reconciliations run with one join."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakerecon import CompactionSpec, ReconSpec, SchemaRegistry, compact, compact_registered, publish_recon, row_recon
from lakerecon.model import PARTITION_COLUMN

AT = datetime(2024, 1, 1)


@pytest.mark.parametrize("fmt, versions", [("parquet", 2), ("orc", 2), ("json", 1)])
def test_a_changed_schema_loses_no_field(spark, folder, fmt, versions):
    registry, spec = SchemaRegistry(spark, f"{folder}/schemas"), CompactionSpec(source_format=fmt)

    def land(df, day):
        df.write.mode("append").format(fmt).save(f"{folder}/in/{PARTITION_COLUMN}={day}")

    land(spark.range(5).withColumn("old", F.lit("x")), "2024-01-01")
    land(spark.range(5, 8).withColumn("new", F.lit(1)), "2024-01-02")
    done = compact_registered(spark, f"{folder}/in", f"{folder}/out", registry, "feed", AT, spec)
    assert done.rows == 8 and len(done.partitions) == 2
    assert registry.versions("feed").filter("kind = 'reader'").count() == versions
    out = spark.read.option("mergeSchema", "true").format(fmt).load(f"{folder}/out")
    assert out.agg(F.count("id"), F.count("old"), F.count("new")).first() == (8, 5, 3)
    assert all(f.nullable for f in registry.latest("feed"))
    nothing = compact_registered(
        spark, f"{folder}/in", f"{folder}/out", registry, "feed", AT, CompactionSpec(source_format=fmt, strategy="missing")
    )
    assert nothing.rows == 0


def test_publishing_agrees_with_the_lazy_frames(spark, folder):
    src = spark.createDataFrame([(i, datetime(2024, 1, 1, 1), i % 7, v) for i in range(50) for v in ("a", "b")], "id int, at timestamp_ntz, n int, s string")
    tgt = src.filter("id % 10 <> 0 AND s = 'b'").withColumn("n", F.when(F.col("id") > 40, -1).otherwise(F.col("n")))
    recon = row_recon(src, tgt, ReconSpec("t", ["id"], ["at", "n", "s"], ["at", "n", "s"], compare=["n"]), datetime(2024, 1, 1, 2))
    done, summary = publish_recon(recon, folder), recon.summary.first().asDict()
    assert done.counts == {k: summary[k] for k in done.counts}
    assert summary["mismatched_record_count"] == 9 and summary["missing_record_count"] == 5
    for one, other in ((done.missing, recon.missing), (done.differences, recon.differences)):
        assert sorted(one.collect()) == sorted(other.select(*one.columns).collect())
    assert done.exceptions.count() == 14


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_two_schemas_inside_one_day_lose_no_field(spark, folder, fmt):
    place = f"{folder}/in/{PARTITION_COLUMN}=2024-01-01"
    spark.range(5).withColumn("old", F.lit("x")).write.mode("append").format(fmt).save(place)
    spark.range(5, 8).withColumn("new", F.lit(1)).write.mode("append").format(fmt).save(place)
    registry, spec = SchemaRegistry(spark, f"{folder}/schemas"), CompactionSpec(source_format=fmt, strategy="from_latest")
    for _ in range(2):
        assert compact_registered(spark, f"{folder}/in", f"{folder}/registered", registry, "feed", AT, spec).rows == 8
    assert registry.versions("feed").count() == 2
    assert compact(spark, f"{folder}/in", f"{folder}/plain", spec).rows == 8
    for out in ("registered", "plain"):
        got = spark.read.option("mergeSchema", "true").format(fmt).load(f"{folder}/{out}")
        assert got.agg(F.count("id"), F.count("old"), F.count("new")).first() == (8, 5, 3)


def test_schemas_that_take_turns_register_once_and_half_saved_ones_are_mended(spark, folder):
    registry = SchemaRegistry(spark, f"{folder}/schemas")
    one, two = spark.range(1).schema, spark.range(1).withColumn("extra", F.lit(1)).schema
    registry.save("f", registry.OBSERVED, two, AT)
    for schema in (one, two, one, two):
        assert registry.reader_schema("f", schema, AT).names == schema.names
    assert registry.versions("f").filter("kind = 'reader'").count() == 2


def test_uncastable_keys_stay_apart_and_equal_keys_meet(spark):
    source = spark.createDataFrame([(k, datetime(2024, 1, 1, 1, i), i) for i, k in enumerate(["1", "01", "oops", "oh", "2"])], "id string, at timestamp_ntz, n int")
    target = spark.createDataFrame([(1, datetime(2024, 1, 1, 1, 1), 1)], "id int, at timestamp_ntz, n int")
    recon = row_recon(source, target, ReconSpec("t", ["id"], ["at", "n"], ["at", "n"]), datetime(2024, 1, 1, 2))
    got = recon.summary.first()
    assert (got["target_row_count"], got["missing_record_count"], got["mismatched_record_count"]) == (1, 3, 0)
    assert sorted(r["id"] for r in recon.uncastable.collect()) == ["oh", "oops"]
