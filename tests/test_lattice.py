"""The lattice of types, and compaction by it."""

import json
import os
import random
from datetime import datetime

import pytest
from pyspark.sql.types import *  # noqa: F403

from lakerecon import PARTITION_COLUMN, CompactionSpec, SchemaRegistry, compact_evolved, join_types, reader_lattice, schemas_by_partition

SCALARS = [
    NullType(), ByteType(), ShortType(), IntegerType(), LongType(), FloatType(), DoubleType(), DecimalType(10, 2), DecimalType(38, 0), DecimalType(38, 38),
    StringType(), BooleanType(), DateType(), TimestampType(), TimestampNTZType(), BinaryType(),
]


def kinds(rng, depth=2):
    if depth == 0 or rng.random() < 0.5:
        return rng.choice(SCALARS)
    if rng.random() < 0.3:
        return ArrayType(kinds(rng, depth - 1), rng.random() < 0.5)
    if rng.random() < 0.2:
        return MapType(StringType(), kinds(rng, depth - 1))
    return StructType([StructField(n, kinds(rng, depth - 1), rng.random() < 0.5) for n in rng.sample("abc", rng.randrange(4))])


def test_joins_do_not_depend_on_order_or_repetition():
    rng = random.Random(7)
    for _ in range(2000):
        a, b, c = (kinds(rng) for _ in range(3))
        assert join_types(a, b).type == join_types(b, a).type
        assert join_types(a, a).type == a and join_types(a, NullType()).type == a
        both = join_types(a, b).type
        assert join_types(both, b).type == both or isinstance(both, StructType)
    versions = [StructType([StructField("x", kinds(rng, 3)), StructField("y", kinds(rng, 1))]) for _ in range(6)]
    wanted = reader_lattice(versions)
    for _ in range(20):
        rng.shuffle(versions)
        assert reader_lattice(versions) == wanted and reader_lattice(versions + versions[:2]) == wanted


@pytest.mark.parametrize(
    ("types", "wanted", "conflicts"),
    [
        (["INT", "BIGINT"], "BIGINT", ()),
        (["BIGINT", "DOUBLE"], "DOUBLE", ()),
        (["INT", "DECIMAL(5,2)"], "DECIMAL(12,2)", ()),
        (["DECIMAL(38,0)", "DECIMAL(10,5)"], "DOUBLE", ()),
        (["INT", "DOUBLE", "STRING"], "STRING", ()),
        (["BOOLEAN", "INT"], "STRING", ()),
        (["DATE", "TIMESTAMP_NTZ"], "TIMESTAMP_NTZ", ()),
        (["STRUCT<a: INT>", "STRUCT<b: STRING, a: BIGINT>"], "STRUCT<a: BIGINT, b: STRING>", ()),
        (["STRUCT<a: INT>", "INT"], "STRING", ("v",)),
        (["STRUCT<a: INT, b: ARRAY<INT>>", "STRUCT<a: STRUCT<c: INT>, b: ARRAY<STRING>>"], "STRUCT<a: STRING, b: ARRAY<STRING>>", ("v.a",)),
        (["ARRAY<STRUCT<x: INT>>", "ARRAY<INT>"], "ARRAY<STRING>", ("v[]",)),
        (["STRUCT<a: STRUCT<c: INT>>", "STRUCT<a: INT>", "INT"], "STRING", ("v",)),
        (["MAP<STRING, INT>", "MAP<STRING, DOUBLE>"], "MAP<STRING, DOUBLE>", ()),
        (["VOID"], "STRING", ()),
    ],
)
def test_reader_types(spark, types, wanted, conflicts):
    found = reader_lattice(StructType.fromDDL(f"v {t}") for t in types)
    assert found.type == StructType.fromDDL(f"v {wanted}") and found.conflicts == conflicts


def land(root, day, rows):
    os.makedirs(f"{root}/{PARTITION_COLUMN}={day}")
    with open(f"{root}/{PARTITION_COLUMN}={day}/part-0.json", "w") as f:
        f.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows)


def test_versions_of_earlier_runs_are_read_too(spark, folder):
    raw, out, at = f"{folder}/in", f"{folder}/out", datetime(2024, 1, 1)
    registry = SchemaRegistry(spark, f"{folder}/schemas")
    land(raw, "2024-01-01", [{"k": 1, "n": {"a": 1}}, "no json", {"k": None}])
    land(raw, "2024-01-02", [{"k": 1.5, "only": True}])
    spec = CompactionSpec(strategy="missing")
    done, conflicts = compact_evolved(spark, raw, out, registry, "f", at, spec)
    assert done.rows == 4 and conflicts == () and len(registry.observed("f")) == 2
    land(raw, "2024-01-03", [{"k": "x", "n": [1, 2]}])
    land(raw, "2024-01-04", ["no json"])
    done, conflicts = compact_evolved(spark, raw, out, registry, "f", at, spec)
    assert [str(d) for d in done.partitions] == ["2024-01-03", "2024-01-04"] and conflicts == ("n",) and len(registry.observed("f")) == 3
    third = spark.read.json(f"{out}/{PARTITION_COLUMN}=2024-01-03").first()
    assert (third.k, third.n) == ("x", "[1, 2]")
    assert compact_evolved(spark, raw, out, registry, "f", at, spec)[0].rows == 0
    with pytest.raises(ValueError):
        compact_evolved(spark, raw, out, registry, "f", at, CompactionSpec(source_format="parquet"))


def test_all_partitions_are_observed_in_one_job(spark):
    lines = spark.createDataFrame([(1, '{"a": 1}'), (1, '{"a": 2.5, "b": []}'), (2, "x"), (3, '{"a": {"b": "t"}}'), (4, None), (5, "[1]")], "day int, value string")
    got = {r.day: StructType.fromDDL(f"p {r.schema}")["p"].dataType for r in schemas_by_partition(lines, "value", "day").collect()}
    assert set(got) == {1, 3} and got[3] == StructType.fromDDL("a STRUCT<b: STRING>") and set(got[1].names) == {"a", "b"}
