"""What the optimiser makes of the main queries."""

import re
from datetime import datetime

import pytest
from conftest import DATA

import __spark_entry__ as entry_point
from lakerecon import ReconSpec, landing_stats, latest_per_key, read_increment, row_recon, within_window
from workloads.verification import line_recon


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (hash|range|RoundRobin|Single)", text))


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{DATA}/lineitem.parquet")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_is_pruned_before_the_shuffle(lines):
    text = plan(latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
    assert text.count("WindowGroupLimit") == 2 and shuffles(text) == 1


def test_comparison_reuses_the_partitioning_of_the_latest_rows(spark, no_broadcast):
    recon = line_recon(spark, DATA)
    assert shuffles(plan(recon.differences)) == 2
    assert shuffles(plan(recon.missing)) == 2
    assert "CartesianProduct" not in plan(recon.summary) and "NestedLoop" not in plan(recon.summary)


def test_window_filter_and_columns_reach_the_scan(spark, lines):
    spec = ReconSpec("t", ["l_orderkey"], ["l_shipdate", "l_quantity"], ["l_shipdate", "l_quantity"])
    text = plan(row_recon(lines, lines, spec, datetime(2000, 1, 1), hot=None).missing)
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "l_extendedprice" not in text


def test_window_filter_is_pushed(lines):
    assert "GreaterThanOrEqual(l_shipdate" in plan(within_window(lines, "l_shipdate", datetime(2000, 1, 1)))


def test_increment_is_pushed(lines):
    text = plan(read_increment(lines, ["l_orderkey", "l_linenumber"], {"l_orderkey": 5, "l_linenumber": 2}))
    assert "GreaterThanOrEqual(l_orderkey,5)" in text


def test_totals_do_not_double_the_rows(lines):
    text = plan(landing_stats(lines, ["l_returnflag"], total=True))
    scan_to_expand = text[text.index("Expand") :]
    assert "HashAggregate" in scan_to_expand


@pytest.mark.parametrize(
    "name", ["recon_summary_lines", "column_diff", "quarantine_split", "dq_failures", "landing_stats_total", "load_history"]
)
def test_no_python_in_the_plan(spark, name):
    text = plan(entry_point.queries()[name](spark, DATA))
    assert not re.search(r"Python|Pandas|CartesianProduct", text)
