"""Landing volumes over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.stats import group_names
from ..sinks.files import write_history
from ..sources.files import _no_data

#: Batches after which their partial counts are folded into one table.
FOLD_EVERY = 50


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(n) for c, n in zip(columns, group_names(columns))]


def landing_stats_stream(
    events: DataFrame, time: str, columns: Sequence[str], length: str = "1 day", lateness: str = "1 hour"
) -> DataFrame:
    """Rows per group and tumbling window; a window is emitted once it can no longer change.

    ``lateness`` bounds how late a row may arrive, and thereby how much state is kept; rows that come later still are
    dropped, see ``corrected_stats_stream``.
    """
    stamped = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    grouped = stamped.groupBy(F.window(time, length).alias("w"), *_named(columns)).agg(F.count("*").alias("rows"))
    return grouped.select(F.col("w.start").alias("window_start"), *group_names(columns), "rows")


def corrected_stats_stream(
    events: DataFrame,
    time: str,
    columns: Sequence[str],
    out: str,
    checkpoint: str,
    length: str = "1 day",
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Rows per group and tumbling window, which late rows correct however late they come.

    No window is ever closed, and there is no state in memory: each batch counts its own rows and writes these partial counts
    under its number, so a batch that is run again replaces them. ``read_corrected_stats`` adds them up. Every ``fold_every``
    batches the sums so far are written as one table under the last number in it, and reading starts there. Rows without a
    time are in no window.
    """
    root = out.rstrip("/")

    def count(batch: DataFrame, number: int) -> None:
        stamped = batch.withColumn(time, F.col(time).cast("timestamp"))
        grouped = stamped.groupBy(F.window(time, length)["start"].alias("window_start"), *_named(columns))
        partial = grouped.agg(F.count("*").alias("rows")).withColumn("batch", F.lit(number).cast("long"))
        write_history(partial, f"{root}/partial", ["batch"], "parquet")
        if (number + 1) % fold_every == 0:
            spark = batch.sparkSession
            folded = read_corrected_stats(spark, root, number)
            write_history(folded.withColumn("upto", F.lit(number).cast("long")), f"{root}/folded", ["upto"], "parquet")

    return events.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if _no_data(error):
            return None
        raise


def read_corrected_stats(spark: SparkSession, out: str, upto: int | None = None) -> DataFrame | None:
    """The counts as they are now, or as of batch ``upto``; None before the first batch.

    Only the newest fold and the partial counts after it are read.
    """
    partial, folded = (_table(spark, f"{out.rstrip('/')}/{kind}") for kind in ("partial", "folded"))
    if partial is None:
        return None
    if upto is not None:
        partial = partial.filter(F.col("batch") <= upto)
        folded = None if folded is None else folded.filter(F.col("upto") < upto)
    last = None if folded is None else folded.agg(F.max("upto")).first()[0]
    parts = partial if last is None else partial.filter(F.col("batch") > last)
    rows = parts.drop("batch")
    if last is not None:
        rows = rows.unionByName(folded.filter(F.col("upto") == last).drop("upto"))
    names = [c for c in rows.columns if c != "rows"]
    return rows.groupBy(*names).agg(F.sum("rows").alias("rows"))
