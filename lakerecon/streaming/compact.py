"""Compaction driven by arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import CompactionSpec
from ..operators.compaction import compact, due_partitions

# The columns of Spark's binaryFile source, of which a stream must be told.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def compact_stream(
    spark: SparkSession,
    source: str,
    target: str,
    spec: CompactionSpec,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Rewrite, from the full source, every partition that received files since the last run.

    Late files are handled whatever their age. A repeated batch rewrites the same partitions. The stream is one of file
    names: which dates are touched is seen from the paths, and files are read by the compaction alone.
    """
    if spec.schema is None:
        raise ValueError("a stream needs a declared schema")
    reader = spark.readStream.format("binaryFile").schema(_FILES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    value = F.regexp_extract("path", rf"/{spec.partition}=([^/]+)/", 1)
    arrived = reader.load(source).select(F.nullif(value, F.lit("")).try_cast("date").alias(spec.partition))

    def rewrite(batch: DataFrame, number: int) -> None:
        days = due_partitions(batch.filter(F.col(spec.partition).isNotNull()), spec.partition)
        compact(batch.sparkSession, source, target, spec, partitions=days)

    return (
        arrived.writeStream.foreachBatch(rewrite)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
