"""Tables kept by key bucket: the latest row per key over all increments, and digests to compare by."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compare import AUTO
from ..operators.digest import BUCKET, BUCKETS, DIGEST, LEAF, LEAVES, DigestRecon, differing_buckets, leaf_digests, recon_leaves, with_leaf
from ..operators.hotkeys import HotKeys
from ..operators.latest import latest_per_key
from ..session import materialise
from ..sinks.files import write_history
from ..sources.files import _no_data

_PART = "_part"


class BucketedTable:
    """Rows in directories by a hash of their key, and beside them the digests of ``columns`` by bucket and leaf.

    ``buckets`` and ``leaves`` belong to the table for good. A bucket is read and replaced whole, so choose ``buckets`` for a
    bucket of a few GB at most, and ``files`` (files of a bucket, each of which one task writes) for files that fit a task.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        columns: Sequence[str],
        buckets: int = BUCKETS,
        leaves: int = LEAVES,
        files: int = 1,
    ):
        self.spark, self.keys, self.columns = spark, list(keys), list(dict.fromkeys([*keys, *columns]))
        self.buckets, self.leaves, self.files = buckets, leaves, files
        self.rows_path, self.digests_path = f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/digests"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as error:
            if _no_data(error):
                return None
            raise

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows, with their bucket and leaf; of ``buckets`` alone if given, and no other directory is read then."""
        found = self._read(self.rows_path)
        return found if found is None or buckets is None else found.filter(F.col(BUCKET).isin(list(buckets)))

    def digests(self) -> DataFrame:
        """Digests by bucket and leaf. Buckets that a run has left unfinished are computed anew."""
        found = self._read(self.digests_path)
        if found is None:
            return leaf_digests(with_leaf(self.spark.createDataFrame([], "k long"), ["k"]), ["k"])
        found = found.select(BUCKET, LEAF, *DIGEST)
        unfinished = [r[0] for r in found.filter("n IS NULL").select(BUCKET).distinct().collect()]
        if not unfinished:
            return found
        sound = found.filter(~F.col(BUCKET).isin(unfinished))
        rows = self.rows(unfinished)
        return sound if rows is None else sound.unionByName(leaf_digests(rows, self.columns))

    def _by_bucket(self, df: DataFrame) -> DataFrame:
        """One task for each file of a bucket."""
        return df.withColumn(_PART, F.col(LEAF) % self.files).repartition(BUCKET, _PART)

    def _store(self, rows: DataFrame, touched: Sequence[int] | None) -> None:
        """Replace the buckets of ``rows``; meanwhile their digests say that they are unfinished.

        ``touched`` are these buckets, None replaces the table.
        """
        if touched is None:
            rows.drop(_PART).write.mode("overwrite").partitionBy(BUCKET).parquet(self.rows_path)
            leaf_digests(self.rows(), self.columns).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.digests_path)
            return
        fields = f"{LEAF} int, n long, high long, low long, mixed long, {BUCKET} int"
        marks = self.spark.createDataFrame([(0, None, None, None, None, b) for b in touched], fields)
        write_history(marks, self.digests_path, [BUCKET], "parquet")
        write_history(rows.drop(_PART), self.rows_path, [BUCKET], "parquet")
        digests = leaf_digests(self.rows(touched), self.columns).select(LEAF, *DIGEST, BUCKET)
        write_history(digests.repartition(BUCKET), self.digests_path, [BUCKET], "parquet")

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the table. Repeated keys stay repeated."""
        self._store(self._by_bucket(with_leaf(df, self.keys, self.buckets, self.leaves)), None)

    def upsert(self, increment: DataFrame, order: Sequence[str], tie_break: Sequence[str] | None = None) -> list[int]:
        """Keep the latest row per key of the table and the increment; gives the buckets that were replaced.

        Which row is the latest depends on ``order`` and then ``tie_break`` (all other columns by default) alone, never on
        the run. So increments may overlap, come late, out of order or twice; a run that failed is simply repeated. The
        increment is reduced to a row per key before it meets the table, of which only its buckets are read.
        """
        latest = latest_per_key(increment, self.keys, order, tie_break)
        fresh = materialise(with_leaf(latest, self.keys, self.buckets, self.leaves), "increment")
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        if not touched:
            return touched
        kept = self.rows(touched)
        both = fresh if kept is None else kept.unionByName(fresh)
        # bucket and part follow from the key, so this ranks without another shuffle
        merged = latest_per_key(self._by_bucket(both), [BUCKET, _PART, *self.keys], order, tie_break)
        self._store(merged, touched)
        return touched


def recon_tables(
    source: BucketedTable, target: BucketedTable, null_safe: bool = True, hot: HotKeys | str | None = AUTO
) -> DigestRecon:
    """Compare two tables by their digests, reading only those buckets of either that differ.

    ``exceptions`` are those of ``compare_rows``, so the source has one row per key. Both tables must be laid out alike.
    """
    layout = [(t.keys, t.columns, t.buckets, t.leaves) for t in (source, target)]
    if layout[0] != layout[1]:
        raise ValueError("the tables differ in keys, columns, buckets or leaves")
    digests = [materialise(t.digests(), "digests") for t in (source, target)]
    found = differing_buckets(*digests)
    rows = [_or_empty(t.rows(found), other) for t, other in ((source, target), (target, source))]
    if rows[0] is None:
        raise ValueError("neither table has been written")
    return recon_leaves(*rows, *digests, source.keys, source.columns, null_safe, hot, found)


def _or_empty(rows: DataFrame | None, other: BucketedTable) -> DataFrame | None:
    if rows is None and (shape := other.rows()) is not None:
        return shape.limit(0)
    return rows
