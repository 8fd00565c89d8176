"""Typed rules in one pass, against the same rules as SQL."""

from datetime import datetime

import pytest

from lakerecon import AuditStamp, DQRule, OrphanRule, RowRule, UniqueRule, run_fused, run_rules

STAMP = AuditStamp("r", datetime(2024, 1, 1))
RULES = [
    RowRule("negative", "child", "v < 0", ["id", "v"]),
    RowRule("odd", "child", "id % 2 = 1", ["id"]),
    OrphanRule("no_parent", "child", ["p"], "parent", ["id"], ["id", "p"]),
    OrphanRule("no_other", "child", ["p", "v"], "parent", ["id", "w"], ["id"]),
    OrphanRule("no_child", "parent", ["id"], "child", ["p"], ["id", "w"]),
    UniqueRule("twice", "parent", ["id", "w"]),
    RowRule("heavy", "parent", "w > 1", ["id"]),
]
SQL = [
    DQRule("negative", "SELECT * FROM {child} WHERE v < 0", ["id", "v"]),
    DQRule("odd", "SELECT * FROM {child} WHERE id % 2 = 1", ["id"]),
    DQRule("no_parent", "SELECT * FROM {child} a WHERE NOT EXISTS (SELECT 1 FROM {parent} b WHERE b.id = a.p)", ["id", "p"]),
    DQRule("no_other", "SELECT * FROM {child} a WHERE NOT EXISTS (SELECT 1 FROM {parent} b WHERE b.id = a.p AND b.w = a.v)", ["id"]),
    DQRule("no_child", "SELECT * FROM {parent} b WHERE NOT EXISTS (SELECT 1 FROM {child} a WHERE b.id = a.p)", ["id", "w"]),
    DQRule("twice", "SELECT id, w, count(*) AS n FROM {parent} GROUP BY id, w HAVING count(*) > 1", ["id", "w", "n"]),
    DQRule("heavy", "SELECT * FROM {parent} WHERE w > 1", ["id"]),
]


@pytest.fixture(scope="module")
def tables(spark):
    child = [(i, None if i % 9 == 0 else i % 7, (i % 5) - 1) for i in range(60)] + [(3, 3, 2)] * 3
    parent = [(i, i % 3) for i in range(5)] + [(2, 2), (None, 0), (None, 0), (11, None), (11, None)]
    return {
        "child": spark.createDataFrame(child, "id int, p int, v int").repartition(3),
        "parent": spark.createDataFrame(parent, "id int, w int").repartition(2),
    }


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_fused_rules_find_what_single_rules_find(spark, tables, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = sorted(map(tuple, run_fused(RULES, tables, STAMP).collect()))
        wanted = sorted(map(tuple, run_rules(spark, SQL, STAMP, tables).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == wanted and {r[0] for r in got} == {r.name for r in RULES}


def test_empty_tables(spark, tables):
    none = {name: df.limit(0) for name, df in tables.items()}
    assert run_fused(RULES, none, STAMP).collect() == []
    only = run_fused(RULES[2:3], {"child": tables["child"], "parent": none["parent"]}, STAMP)
    assert only.count() == tables["child"].count()
    with pytest.raises(ValueError):
        OrphanRule("x", "a", ["k"], "b", ["k", "l"], ["k"])


def test_a_table_is_read_once_for_all_its_rules(spark, folder, tables):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    count = lambda rules, name: _plan(run_fused(rules, stored, STAMP)).count(f"{folder}/{name}]")
    assert count(RULES[:3], "child") == 1 and count(RULES[:3], "parent") == 1
    # the unique rule's counts give the parent's keys too: one shuffle, read twice
    pair = [RULES[2], RULES[5]]
    assert count(pair, "child") == 1 and count(pair, "parent") == 1 and "ReusedExchange" in _plan(run_fused(pair, stored, STAMP))


def _plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]
