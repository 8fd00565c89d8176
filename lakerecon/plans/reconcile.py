"""Reconciliation pipelines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.align import align_names, align_types, misfit, normalise_ts, project_exprs, within_window
from ..functions.times import recon_dates
from ..model import PARTITION_COLUMN, AuditStamp, CountReconSpec, ReconSpec
from ..operators.compare import AUTO, STRAY, column_diff, compare_rows, missing_records, recon_summary, records_and_rows
from ..operators.counts import count_recon, recon_alerts
from ..operators.hotkeys import HotKeys, find_hot_keys
from ..operators.latest import latest_per_key
from ..operators.stats import counted
from ..session import materialise
from ..sinks.audit import append_audit
from ..sinks.files import export_missing
from ..sources.files import read_partitions


@dataclass(frozen=True)
class RowRecon:
    """The frames of one reconciliation.

    ``uncastable`` are the source records with a value that does not fit the target's type. The value is
    compared as null; where it is a key, each such record is missing in the target. ``keyed`` are the source's keys, with those
    records marked if there can be any.
    """

    spec: ReconSpec
    hot: HotKeys | None
    source: DataFrame
    latest: DataFrame
    target: DataFrame
    missing: DataFrame
    compared: DataFrame
    differences: DataFrame
    summary: DataFrame
    uncastable: DataFrame
    keyed: DataFrame


def prepare_source(source: DataFrame, spec: ReconSpec, as_of: datetime) -> DataFrame:
    """Project the configured fields and keep the window, filtering as early as possible."""
    if not spec.expressions:
        source = within_window(source, spec.event_time, as_of, spec.hours)
        return project_exprs(source, spec.keys, spec.source_fields)
    projected = project_exprs(source, spec.keys, spec.source_fields, spec.expressions)
    return within_window(projected, spec.event_time, as_of, spec.hours)


def prepare_target(target: DataFrame, spec: ReconSpec, as_of: datetime) -> DataFrame:
    """Keep the window and rename the target's fields to the source's names."""
    kept = within_window(target, spec.target_fields[0], as_of, spec.hours)
    return align_names(kept, spec.keys, spec.source_fields, spec.target_fields)


def row_recon(
    source: DataFrame, target: DataFrame, spec: ReconSpec, as_of: datetime, hot: HotKeys | str | None = AUTO
) -> RowRecon:
    """Compare the latest source record per key with the serving table over one window.

    ``hot`` describes keys repeated many times in the target; None says its keys are unique.
    """
    src = prepare_source(source, spec, as_of)
    tgt = prepare_target(target, spec, as_of)
    tgt = normalise_ts(tgt, spec.timestamps)
    uncastable = src.filter(misfit(src, tgt, [*spec.keys, *(f for f in spec.source_fields if f not in spec.timestamps)]))
    # Keys first: two source keys that are one in the target's type are one record.
    stray, raw = misfit(src, tgt, spec.keys), src
    src = align_types(raw, tgt, spec.keys)
    if all(raw.schema[k].dataType == src.schema[k].dataType for k in spec.keys):
        latest = latest_per_key(src, spec.keys, [spec.event_time], spec.tie_break)
        counted_keys = src.select(*spec.keys)
    else:
        # Keys that do not fit are null now. They are records of their own and not one key.
        keyed = align_types(raw.filter(~stray), tgt, spec.keys)
        latest = latest_per_key(keyed, spec.keys, [spec.event_time], spec.tie_break)
        latest = latest.unionByName(align_types(raw.filter(stray), tgt, spec.keys))
        counted_keys = align_types(raw.select(*spec.keys, stray.alias(STRAY)), tgt, spec.keys)
    latest = normalise_ts(latest, spec.timestamps)
    aligned = align_types(latest, tgt, [*spec.keys, *spec.source_fields])
    columns = spec.compared_columns
    if hot == AUTO:
        hot = find_hot_keys(tgt, spec.keys)
    compared = compare_rows(aligned, tgt, spec.keys, columns, hot=hot)
    return RowRecon(
        spec=spec,
        hot=hot,
        source=src,
        latest=aligned,
        target=tgt,
        missing=missing_records(aligned, tgt, spec.keys, hot=None),
        compared=compared,
        differences=column_diff(compared, spec.keys, columns),
        summary=recon_summary(compared, counted_keys, spec.keys, spec.table, len(aligned.columns), len(tgt.columns)),
        uncastable=uncastable,
        keyed=counted_keys,
    )


@dataclass(frozen=True)
class PublishedRecon:
    """A reconciliation that has been run: its counts, and the rows that are not equal."""

    counts: dict[str, object]
    exceptions: DataFrame
    missing: DataFrame
    differences: DataFrame


def publish_recon(recon: RowRecon, out: str) -> PublishedRecon:
    """Run a reconciliation with one join: count all pairs, keep only those that are not equal.

    The rows of ``out`` are normally few; the missing records and the differences are read from
    there. The frames of ``recon`` would each run the join again.
    """
    spec, keys, columns = recon.spec, list(recon.spec.keys), recon.spec.compared_columns
    compared = compare_rows(recon.latest, recon.target, keys, columns, hot=recon.hot, carry=spec.source_fields)
    compared, seen = counted(
        compared,
        "pairs",
        target_row_count=F.count_if(F.col("present_in") != "source"),
        missing_record_count=F.count_if(F.col("present_in") == "source"),
        mismatched_record_count=F.count_if("is_mismatch"),
    )
    compared.filter((F.col("present_in") != "both") | F.col("is_mismatch")).write.mode("overwrite").parquet(out)
    exceptions = recon.source.sparkSession.read.schema(compared.schema).parquet(out)
    records, rows = records_and_rows(recon.keyed, keys).first()
    observed = {k: v for k, v in seen.get.items() if k != "pairs"}
    return PublishedRecon(
        counts={"table_name": spec.table, "source_record_count": records, "source_row_count": rows, **observed},
        exceptions=exceptions,
        missing=exceptions.filter("present_in = 'source'").select(
            *keys, *[F.col(f"_src.{c}").alias(c) for c in spec.source_fields]
        ),
        differences=column_diff(exceptions, keys, columns),
    )


@dataclass(frozen=True)
class ReconRun:
    """``published`` is None when no directory of the window exists; ``exported`` rows are in the CSV files."""

    dates: tuple[date, ...]
    published: PublishedRecon | None
    exported: int


def recon_run(
    spark: SparkSession,
    source: str,
    target: DataFrame,
    spec: ReconSpec,
    as_of: datetime,
    out: str,
    fmt: str = "json",
    schema: StructType | str | None = None,
    partition: str = PARTITION_COLUMN,
    hot: HotKeys | str | None = AUTO,
) -> ReconRun:
    """One whole reconciliation from paths: gate, scan, compare, export.

    Of the dated directories below ``source`` those of the window are read, whichever of them exist; without any the run
    ends there, and neither side is read. Rows that are not equal go to ``out/exceptions``, missing rows to
    ``out/missing`` as CSV. A repeated run replaces both.
    """
    dates = tuple(recon_dates(as_of, spec.hours))
    found = read_partitions(spark, source, dates, fmt, schema, partition)
    if found is None:
        return ReconRun(dates, None, 0)
    published = publish_recon(row_recon(found.drop(partition), target, spec, as_of, hot), f"{out.rstrip('/')}/exceptions")
    return ReconRun(dates, published, export_missing(published.missing, f"{out.rstrip('/')}/missing"))


def publish_count_control(
    spark: SparkSession,
    spec: CountReconSpec,
    table: str,
    stamp: AuditStamp,
    views: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
    left_prefix: str = "left_",
    right_prefix: str = "right_",
) -> DataFrame:
    """Run one control, append its ``audit_fields`` with run time and id to ``table``, and give its alerts.

    ``audit_fields`` are SQL expressions over the result of ``count_recon`` (all of its columns if there are none); alerts
    carry them too. The counts are joined once; both sinks read the result.
    """
    recon = materialise(run_count_controls(spark, [spec], views, params, left_prefix, right_prefix), "control")
    fields = list(spec.audit_fields) or recon.columns
    append_audit(recon.selectExpr(*fields), table, stamp)
    # the alert has these two itself
    extra = [F.expr(f) for f in fields if f not in ("ctrl_name", "differences")]
    return recon_alerts(recon, extra, stamp)


def run_count_controls(
    spark: SparkSession,
    specs: Sequence[CountReconSpec],
    views: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
    left_prefix: str = "left_",
    right_prefix: str = "right_",
) -> DataFrame:
    """Run several controls with the same keys and columns as one frame, hence one job and one write."""
    args, views = dict(params or {}), dict(views or {})
    results = []
    for spec in specs:
        left = spark.sql(spec.left_sql, args=args, **views)
        right = spark.sql(spec.right_sql, args=args, **views)
        results.append(
            count_recon(left, right, spec.keys, spec.control, spec.table, left_prefix, right_prefix)
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), results)
