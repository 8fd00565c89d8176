"""Data-quality rules: each rule is SQL returning the rows that violate it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.schemas import wall_clock
from ..functions.times import eastern_text
from ..model import AuditStamp, DQRule, OrphanRule, RowRule, UniqueRule
from ..sinks.audit import append_audit


def run_rules(
    spark: SparkSession,
    rules: Sequence[DQRule],
    stamp: AuditStamp,
    views: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """All violations of all rules in one frame, hence one job: rule, fields as JSON, run id, run time.

    ``views`` are the frames a rule names as ``{name}``, ``params`` the values it names as ``:name``.
    """
    failures = [
        spark.sql(rule.sql, args=dict(params or {}), **(views or {})).select(
            F.lit(rule.name).alias("rule_name"), F.to_json(F.struct(*rule.fields)).alias("record"), *_stamped(stamp)
        )
        for rule in rules
    ]
    return reduce(DataFrame.unionAll, failures)


def _stamped(stamp: AuditStamp) -> list[Column]:
    at = wall_clock(stamp.at)
    return [
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("job_run_time"),
        eastern_text(at).alias("job_run_time_est"),
        F.lit(stamp.run_id).alias("run_id"),
    ]


def run_fused(
    rules: Sequence[RowRule | OrphanRule | UniqueRule], tables: Mapping[str, DataFrame], stamp: AuditStamp
) -> DataFrame:
    """The violations of typed rules as ``run_rules`` gives them, reading each table as seldom as can be.

    All row and orphan rules of a table are evaluated in one scan of it. Orphan rules with the same keys and parent share
    one join, those with the same keys one shuffle of the table; a small parent is broadcast by Spark, and hot keys of the
    table are split by adaptive execution, as only its own shuffle stands before the join. A parent is reduced to its keys in
    each task. If a unique rule counts keys of that parent, the parent's keys come from those counts, whose shuffle Spark
    does once. Else a table that has rules and is a parent is read once for either, for the parent with its keys alone.
    """
    rules = list(rules)
    unique = [r for r in rules if isinstance(r, UniqueRule)]
    found = []
    for name in dict.fromkeys(r.table for r in rules if not isinstance(r, UniqueRule)):
        mine = [r for r in rules if r.table == name and not isinstance(r, UniqueRule)]
        found.append(_row_violations(tables, mine, unique))
    for rule in unique:
        counts = _counts(tables[rule.table], rule.keys).filter("n > 1")
        found.append(counts.select(F.lit(rule.name).alias("rule_name"), F.to_json(F.struct(*rule.keys, "n")).alias("record")))
    return reduce(DataFrame.unionAll, found).select("rule_name", "record", *_stamped(stamp))


def _counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def _parents(tables: Mapping[str, DataFrame], parent: str, keys: Sequence[str], unique: Sequence[UniqueRule]) -> DataFrame:
    """The parent's keys with the number of its rows, from the counts of a unique rule if there is one."""
    for rule in unique:
        if rule.table == parent and set(keys) <= set(rule.keys):
            return _counts(tables[parent], rule.keys).groupBy(*keys).agg(F.sum("n").alias("n"))
    return _counts(tables[parent], keys)


def _row_violations(tables: Mapping[str, DataFrame], rules: Sequence[RowRule | OrphanRule], unique: Sequence[UniqueRule]) -> DataFrame:
    df = tables[rules[0].table]
    names = df.columns
    # the same keys stand together, so that the table is shuffled for them once
    families = sorted({(tuple(r.keys), r.parent, tuple(r.parent_keys)) for r in rules if isinstance(r, OrphanRule)})
    marks = {}
    for i, (keys, parent, parent_keys) in enumerate(families):
        marks[keys, parent, parent_keys] = mark = f"_parent_{i}"
        known = _parents(tables, parent, parent_keys, unique).select(*(F.col(p).alias(f"{mark}_{j}") for j, p in enumerate(parent_keys)), F.col("n").alias(mark))
        # null-safe, or a filter of null keys would go below the counts and keep Spark from sharing them
        same = [df[k].eqNullSafe(known[f"{mark}_{j}"]) for j, k in enumerate(keys)]
        df = df.join(known, reduce(lambda a, b: a & b, same), "left")
        df = df.select(*names, *marks.values())
    entries = []
    for rule in rules:
        if isinstance(rule, RowRule):
            failed = F.expr(rule.violated)
        else:
            mark = F.col(marks[tuple(rule.keys), rule.parent, tuple(rule.parent_keys)])
            failed = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in rule.keys], mark.isNull())
        entry = F.struct(F.lit(rule.name).alias("rule_name"), F.to_json(F.struct(*rule.fields)).alias("record"))
        entries.append(F.when(failed, entry))
    return df.select(F.explode(F.array_compact(F.array(*entries))).alias("f")).select("f.rule_name", "f.record")


def rule_summary(failures: DataFrame, rules: Sequence[DQRule]) -> DataFrame:
    """Failed rows per rule; rules nobody violated appear with zero."""
    names = failures.sparkSession.createDataFrame([(r.name,) for r in rules], "rule_name string")
    counts = failures.groupBy("rule_name").agg(F.count("*").alias("n"))
    failed = F.coalesce("n", F.lit(0))
    return names.join(counts, "rule_name", "left").select(
        "rule_name",
        failed.alias("failed_rows"),
        F.when(failed > 0, "failed").otherwise("passed").alias("status"),
    )


def append_failures(failures: DataFrame, table: str, stamp: AuditStamp) -> None:
    """Append violations to an audit table."""
    append_audit(failures.drop("run_id", "job_run_time", "job_run_time_est"), table, stamp)
