"""Lines that many documents share are dropped from all of them.

A line is what stands between two ``\\n``; its key is the line without blanks (0x20, 0x09 to 0x0D) at both ends and with A-Z
lower-cased. Lines are exploded to 128-bit hashes of their keys, at most one for each document and key; documents are
counted by hash, combined before the shuffle. Lines whose key is found in enough documents go, the others are put together
again by position, as they were.

Hashes of dropped lines reach the texts in two ways, both exact. At most SENT of them, those of most documents, are
broadcast: a key in more than one SENT-th of all (document, key) pairs is always among these, so that no hot key is
shuffled. The others are joined by hash with the positions of lines, without texts, and their positions with the texts.

Every row is one document, so a repeated row counts again and rows with a null id count too. A null or empty text is one
empty line. Empty keys are never dropped while ``least_chars`` is 1 or more. A text all of whose lines go becomes empty.
Other columns are carried along, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import cut, map_batches

#: Hashes that are broadcast: 16 bytes each, about 100 as a set in each worker.
SENT = 1 << 18

_HASH = [T.StructField("high", T.LongType()), T.StructField("low", T.LongType())]
_PAIR = np.dtype([("high", ">u8"), ("low", ">u8")])


def key(line: bytes) -> bytes:
    return line.strip().lower()


def _long_enough(line: bytes, least_chars: int) -> bool:
    return len(line) >= least_chars and (least_chars < 2 or len(line.decode()) >= least_chars)


def _keys(text: bytes | None, least_chars: int) -> list[bytes | None]:
    """The hash of each line's key, None where the key is too short to be dropped."""
    keys = map(key, (text or b"").split(b"\n"))
    return [xxhash.xxh3_128_digest(line) if _long_enough(line, least_chars) else None for line in keys]


def _columns(hashes: list[bytes]) -> list[pa.Array]:
    numbers = np.frombuffer(b"".join(hashes), _PAIR)
    return [pa.array(numbers[name].astype(np.uint64).view(np.int64)) for name in _PAIR.names]


def _collected(hashes: DataFrame) -> frozenset[bytes]:
    found = hashes.select(*_PAIR.names).toArrow()
    numbers = np.empty(found.num_rows, _PAIR)
    for name in _PAIR.names:
        numbers[name] = found.column(name).to_numpy().view(np.uint64)
    packed = numbers.tobytes()
    return frozenset(packed[i : i + _PAIR.itemsize] for i in range(0, len(packed), _PAIR.itemsize))


def shared(documents: DataFrame, least_documents: int = 10, least_chars: int = 1, text_column: str = "text") -> DataFrame:
    """``high``, ``low`` and ``n_documents`` of the keys of ``least_chars`` code points found in at least so many documents."""

    def run(batches):
        for batch in batches:
            for piece in texts.pieces(texts.column(batch, "text")):
                found = [line for text in piece for line in {*_keys(text, least_chars)} if line]
                yield pa.RecordBatch.from_arrays(_columns(found), names=["high", "low"])

    lines = map_batches(documents.select(F.col(text_column).cast("string").alias("text")), run, T.StructType(_HASH))
    return lines.groupBy("high", "low").agg(F.count("*").alias("n_documents")).filter(F.col("n_documents") >= least_documents)


def drop(documents: DataFrame, least_documents: int = 10, least_chars: int = 1, text_column: str = "text") -> DataFrame:
    """The documents without the lines that ``least_documents`` share, with ``n_lines`` (before) and ``n_dropped`` added last.

    New names that the input has already get as many underscores in front as make them new.
    """
    spark, columns = documents.sparkSession, documents.columns
    names = [f"_c{i}" for i in range(len(columns))]
    text = names[columns.index(text_column)]
    numbered = documents.toDF(*names)
    gone = cut(shared(documents, least_documents, least_chars, text_column), "shared-lines")
    # fewer than SENT hashes can be in more than a SENT-th of all pairs
    pairs = gone.agg(F.sum("n_documents")).first()[0] or 0
    often = F.col("n_documents") > pairs // SENT
    known = spark.sparkContext.broadcast(_collected(gone.filter(often)))
    rest = gone.filter(~often)
    others = [name for name in names if name != text]
    rows = numbered.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), F.col(text).cast("string").alias("text"))
    if rest.isEmpty():
        rows = rows.withColumn("places", F.lit(None).cast("array<int>"))
    else:
        rows = rows.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).join(_places(rows, rest, known, least_chars), "digest", "left").drop("digest")

    def run(batches):
        here = known.value
        for batch in batches:
            at, places = 0, batch.column(2)
            for piece in texts.pieces(texts.column(batch, "text")):
                kept, sizes, drops = [], [], []
                for i, text in enumerate(piece, at):
                    lines = (text or b"").split(b"\n")
                    also = set(places[i].as_py() or ())
                    stays = [
                        line for n, (line, hashed) in enumerate(zip(lines, _keys(text, least_chars), strict=True))
                        if hashed not in here and n not in also
                    ]
                    kept.append(b"\n".join(stays))
                    sizes.append(len(lines))
                    drops.append(len(lines) - len(stays))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(piece)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                        pa.array(sizes, pa.int64()),
                        pa.array(drops, pa.int64()),
                    ],
                    names=["row", "kept", "n_lines", "n_dropped"],
                )
                at += len(piece)

    schema = T.StructType([rows.schema["row"], *T.StructType.fromDDL("kept string, n_lines long, n_dropped long").fields])
    found = map_batches(rows, run, schema)
    added = []
    for name in ("n_lines", "n_dropped"):
        while name in columns:
            name = f"_{name}"
        added.append(name)
    return found.select(*(F.col("kept") if name == text else F.col(f"row.{name}") for name in names), "n_lines", "n_dropped").toDF(*columns, *added)


def _places(rows: DataFrame, rest: DataFrame, known, least_chars: int) -> DataFrame:
    """Positions of lines whose hash is in ``rest``, by the digest of the whole text.

    Such a line is in few documents, so neither a hash nor a text has many rows here.
    """

    def run(batches):
        here = known.value
        for batch in batches:
            for piece in texts.pieces(texts.column(batch, "text")):
                for text in piece:
                    found = [(n, line) for n, line in enumerate(_keys(text, least_chars)) if line and line not in here]
                    if found:
                        digest = pa.array([hashlib.sha256(text or b"").hexdigest()] * len(found), pa.string())
                        numbers = pa.array([n for n, _ in found], pa.int32())
                        yield pa.RecordBatch.from_arrays([digest, numbers, *_columns([x for _, x in found])], names=["digest", "n", "high", "low"])

    schema = T.StructType([*T.StructType.fromDDL("digest string, n int").fields, *_HASH])
    lines = map_batches(rows.select("text"), run, schema)
    return lines.join(rest.select("high", "low"), ["high", "low"]).groupBy("digest").agg(F.collect_set("n").alias("places"))
