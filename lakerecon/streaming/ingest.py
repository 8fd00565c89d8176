"""Incremental file ingest: the checkpoint remembers which files were read."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.payload import PAYLOAD, flatten_payload, is_bad, quarantine_rows, unbox
from ..functions.schemas import as_struct
from ..operators.stats import counted
from ..session import materialise
from ..sinks.files import MICROSECONDS

BATCH = "ingest_batch"
_SEEN = "_seen"


def ingest_stream(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    payload: str,
    payload_schema: StructType | str,
    out: str,
    quarantine: str,
    checkpoint: str,
    by: Sequence[str],
    feed: str,
    keep: Sequence[str] = (),
    fmt: str = "json",
    max_files: int | None = None,
    unique: Sequence[str] = (),
    within: str = "7 days",
) -> StreamingQuery:
    """Read new files, unbox the payload, land good rows by ``by`` and reject the others.

    Everything that is there is processed, in batches of at most ``max_files`` files, then the query
    stops. Each batch owns the sub-partition ``ingest_batch=<feed>-<number>``, so a batch that is
    run again after a failure replaces its own files. ``feed`` must change when a checkpoint is
    thrown away. ``keep`` are columns beside the payload to land, the partition columns among them.

    ``unique`` are columns that identify a delivery: of rows that agree in them only the first is landed or rejected, if they
    arrive ``within`` that time of each other, in whatever files, batches and starts. Time is that of the batch, as its log
    entry has it, so no row is ever too late, and a batch that is run again decides alike. Rows with a null in ``unique``
    are all kept.
    """
    reader = spark.readStream.format(fmt).schema(as_struct(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    arrived = reader.load(source)
    if unique:
        arrived = first_deliveries(arrived, unique, within)
    parsed = unbox(arrived, payload, payload_schema)

    def land(batch: DataFrame, number: int) -> None:
        name = f"{feed}-{number}"
        if unique:
            # What has been seen is noted while the batch is computed, which must happen once.
            batch = materialise(batch, "deliveries")
        seen_rows, seen = counted(batch, bad=F.count_if(is_bad()))
        good = flatten_payload(seen_rows.filter(~is_bad()), PAYLOAD, keep=keep, **{BATCH: name})
        _replace(good, out, [*by, BATCH])
        if seen.get["bad"]:
            _replace(quarantine_rows(batch, payload).withColumn(BATCH, F.lit(name)), quarantine, [BATCH])

    return (
        parsed.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_deliveries(arrived: DataFrame, unique: Sequence[str], within: str) -> DataFrame:
    """A stream without rows whose ``unique`` columns came before, ``within`` the time of batches."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in unique])
    stamped = arrived.filter(known).withColumn(_SEEN, F.current_timestamp()).withWatermark(_SEEN, within)
    return stamped.dropDuplicatesWithinWatermark(list(unique)).drop(_SEEN).unionByName(arrived.filter(~known))


def _replace(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.options(**MICROSECONDS, compression="gzip").partitionBy(*by).json(path)
