"""Language-model scoring with a log-frequency Bloom filter.

Counts of n-grams (n from 2 to ORDER, those seen LEAST times or more) are quantised on a logarithmic scale: level
q = 1 + floor(log_BASE(count / LEAST)). The filter holds (n-gram, 1) ... (n-gram, q). A lookup asks for level 1, 2,
... until one is missing; the last one found gives the count up to a factor of BASE, of which the least is taken for
what is seen and the most for its history, so that the probabilities after a history never add up to more than 1. Counts
of single words are exact, in 64 bits. Probabilities are smoothed with Dirichlet priors, from short histories to long ones:

    p(w) = (c(w) + A) / (N + A (V + 1)),    p(w | h) = (c(h w) + MU p(w | shorter h)) / (c(h) + MU)

Words are counted by 64-bit hashes in tasks and merged in buckets of the hash range, so a word that a third of all
rows hold is one number per task. Each bucket becomes one segment of the filter, with as many bits as
its n-grams need; nothing else decides its size. Longer n-grams are counted only where both their
parts are in the filter, which has no false negatives, so no count is lost.

What is broadcast is checked: words and filter are cut into parts of at most PART_BYTES by buckets. One
part is the usual case; with more, each part is broadcast in turn, the levels found are kept beside the
texts in a table, and the last step scores. The result is the same.

A token is a word, lower-cased in A-Z, or the end of the text. Null and empty texts have the end only.
Rows with null or repeated ids are scored and learned like any others, one row out for one row in. Without training
rows every count is 0. Other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import cut, map_batches, map_groups

ORDER = 3
LEAST = 2
BASE = 1.5
A = 0.1
MU = 8.0
BITS = 10
PROBES = 7
PART_BYTES = 192 << 20

#: Begins with a blank, so no word is equal to it.
EDGE = b" edge"
#: N-grams that a task holds before it merges them, and before it hands them on.
_MERGE, _HAND_ON = 1 << 21, 1 << 22
#: Tokens per bucket of the hash range.
_BUCKET = 1 << 20


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.concatenate([np.empty(0, np.uint64), *hashes]), np.concatenate([np.empty(0, np.int64), *counts])
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


class _Counts:
    """Counts of hashes in a task; given away as rows (bucket, once, often, counts)."""

    def __init__(self, buckets: int):
        self.buckets, self.hashes, self.counts, self.held = buckets, [], [], 0

    def add(self, hashes: np.ndarray):
        h, c = np.unique(hashes, return_counts=True)
        self.hashes.append(h)
        self.counts.append(c)
        self.held += len(h)
        if self.held > _MERGE and len(self.hashes) > 1:
            h, c = _merged(self.hashes, self.counts)
            self.hashes, self.counts, self.held = [h], [c], len(h) // 2
            if len(h) > _HAND_ON:
                yield from self.rows()

    def rows(self):
        h, c = _merged(self.hashes, self.counts)
        self.hashes, self.counts, self.held = [], [], 0
        at = np.searchsorted(_bucket(h, self.buckets), np.arange(self.buckets + 1))
        for lo in range(0, self.buckets, 1024):
            number, once, often, counts = [], [], [], []
            for b in range(lo, min(lo + 1024, self.buckets)):
                x, n = h[at[b] : at[b + 1]], c[at[b] : at[b + 1]]
                if len(x):
                    number.append(b)
                    once.append(x[n == 1].tobytes())
                    often.append(x[n > 1].tobytes())
                    counts.append(n[n > 1].tobytes())
            if number:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), *(pa.array(v, pa.binary()) for v in (once, often, counts))], names=["bucket", "once", "often", "counts"]
                )


def _bucket_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    hashes, counts = [], []
    for once, often, n in zip(*(table.column(k) for k in ("once", "often", "counts")), strict=True):
        hashes += [np.frombuffer(once.as_buffer(), np.uint64), np.frombuffer(often.as_buffer(), np.uint64)]
        counts += [np.ones(len(hashes[-2]), np.int64), np.frombuffer(n.as_buffer(), np.int64)]
    return _merged(hashes, counts)


def _probes(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the probes for (hash, level): probe i is bit (start + i * step) modulo the bits of the segment."""
    mixed = texts.mix(hashes ^ np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)


def _segment(hashes: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """n-grams kept, and the bits of one bucket of the filter."""
    keep = counts >= LEAST
    hashes, levels = hashes[keep], 1 + np.floor(np.log(counts[keep] / LEAST) / np.log(BASE) + 1e-9).astype(np.int64)
    size = max(8, -(-BITS * int(levels.sum()) // 8) * 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        low, high = _probes(hashes[levels >= level], level)
        for i in range(PROBES):
            bits[(low + np.uint64(i) * high) % np.uint64(size)] = True
    return len(hashes), np.packbits(bits, bitorder="little").tobytes()


@dataclass
class Part:
    """Some buckets of the words (sorted hashes and counts) and of the filter (bits, start and size of each bucket)."""

    word_buckets: int
    loaded: np.ndarray
    words: np.ndarray
    counts: np.ndarray
    grams: dict[int, tuple[int, np.ndarray, np.ndarray, np.ndarray]]

    def word_counts(self, hashes: np.ndarray) -> np.ndarray:
        """Counts of the words, 0 for those of other parts."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64)
        some, back = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, some), len(self.words) - 1)
        return np.where(self.words[at] == some, self.counts[at], 0).astype(np.int64)[back]

    def levels(self, n: int, hashes: np.ndarray, most: int = 255) -> np.ndarray:
        """Levels of the n-grams up to ``most``, 0 for those of other parts and those not in the filter."""
        buckets, bits, starts, sizes = self.grams[n]
        # Frequent n-grams have the most levels, so each is looked for once; in order, those of a segment come together.
        some, back = np.unique(hashes, return_inverse=True)
        found = np.zeros(len(some), np.uint8)
        at = _bucket(some, buckets)
        active = np.flatnonzero(sizes[at] > 0)
        level = 1
        while len(active) and level <= most:
            own = at[active]
            first, size = starts[own], sizes[own]
            low, high = _probes(some[active], level)
            position, step = low % size, high % size
            for i in range(PROBES):
                if i:
                    position = position + step
                    position = np.where(position >= size, position - size, position)
                byte = bits[first + (position >> np.uint64(3)).astype(np.int64)]
                set_ = np.flatnonzero(byte >> (position & np.uint64(7)).astype(np.uint8) & 1)
                if len(set_) < len(active):
                    active, first, size, position, step = (x[set_] for x in (active, first, size, position, step))
            found[active] = level
            level += 1
        return found[back]


@dataclass
class Model:
    """Tables of word counts and filter segments, and what scoring needs besides."""

    words: DataFrame
    grams: dict[int, DataFrame]
    word_buckets: int
    gram_buckets: int
    tokens: int
    distinct: int
    size: int
    part_bytes: int

    def parts(self) -> int:
        return max(1, -(-self.size // self.part_bytes))

    def part(self, number: int) -> Part:
        """The part in the driver; its size is bounded by ``part_bytes`` and one bucket of each table."""
        inside = lambda buckets: (F.floor(F.col("bucket") * self.parts() / buckets) == number)
        rows = sorted(self.words.filter(inside(self.word_buckets)).select("bucket", "hashes", "counts").collect())
        words = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r.hashes, np.uint64) for r in rows)])
        counts = np.concatenate([np.empty(0, np.int64), *(np.frombuffer(r["counts"], np.int64) for r in rows)])
        loaded = np.zeros(self.word_buckets, bool)
        loaded[[r.bucket for r in rows]] = True
        grams = {}
        for n, table in self.grams.items():
            rows = sorted(table.filter(inside(self.gram_buckets)).select("bucket", "bits").collect())
            starts, sizes, at = np.zeros(self.gram_buckets, np.int64), np.zeros(self.gram_buckets, np.uint64), 0
            for r in rows:
                starts[r.bucket], sizes[r.bucket] = at, 8 * len(r.bits)
                at += len(r.bits)
            grams[n] = (self.gram_buckets, np.frombuffer(b"".join(r.bits for r in rows), np.uint8), starts, sizes)
        return Part(self.word_buckets, loaded, words, counts, grams)


def _grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """For every position of the sequence the hash of the n-gram that ends there; 0 if it begins before the text does."""
    found, at = texts.ngrams(hashes, bounds, n)
    out = np.zeros(len(hashes), np.uint64)
    ends = np.ones(len(hashes), bool)
    for j in range(n - 1):
        first = bounds[:-1] + j
        ends[first[first < bounds[1:]]] = False
    out[ends] = found
    return out


def train(documents: DataFrame, text_column: str = "text", order: int = ORDER, part_bytes: int = PART_BYTES) -> Model:
    """Count words and n-grams of all documents and build the filter."""
    rows = documents.select(F.col(text_column).cast("string").alias("text"))
    schema = "bucket int, once binary, often binary, counts binary"
    word_buckets = max(16, 4 * rows.rdd.getNumPartitions())

    def count_words(batches):
        counts = _Counts(word_buckets)
        for batch in batches:
            for piece in texts.pieces(texts.column(batch, "text")):
                hashes, bounds = texts.tokens(piece, edge=EDGE)
                keep = np.ones(len(hashes), bool)
                keep[bounds[:-1]] = False
                yield from counts.add(hashes[keep])
        yield from counts.rows()

    def merge_words(table: pa.Table) -> pa.Table:
        hashes, counts = _bucket_counts(table)
        return pa.table(
            {
                "bucket": table.column("bucket").slice(0, 1), "hashes": pa.array([hashes.tobytes()], pa.binary()),
                "counts": pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
                "distinct": pa.array([len(hashes)], pa.int64()), "tokens": pa.array([int(counts.sum())], pa.int64()),
            }
        )

    words = cut(
        map_groups(map_batches(rows, count_words, schema), "bucket", merge_words, "bucket int, hashes binary, counts binary, distinct long, tokens long"),
        "lm-words",
    )
    seen = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).first()
    gram_buckets = max(16, -(-seen.tokens // _BUCKET))
    model = Model(words, {}, word_buckets, gram_buckets, seen.tokens, seen.distinct, 16 * seen.distinct, part_bytes)

    def merge_grams(table: pa.Table) -> pa.Table:
        kept, bits = _segment(*_bucket_counts(table))
        return pa.table({"bucket": table.column("bucket").slice(0, 1), "bits": pa.array([bits], pa.binary()), "kept": pa.array([kept], pa.int64())})

    for n in range(2, order + 1):
        shorter = None
        if n > 2:
            only = Model(words.limit(0), {n - 1: model.grams[n - 1]}, word_buckets, gram_buckets, 0, 0, bits_before, part_bytes)
            if only.parts() == 1:
                shorter = documents.sparkSession.sparkContext.broadcast(only.part(0))

        def count_grams(batches, n=n, shorter=shorter):
            counts = _Counts(gram_buckets)
            for batch in batches:
                for piece in texts.pieces(texts.column(batch, "text")):
                    hashes, bounds = texts.tokens(piece, edge=EDGE)
                    found = _grams(hashes, bounds, n)
                    keep = found > 0
                    if shorter is not None:
                        known = shorter.value.levels(n - 1, _grams(hashes, bounds, n - 1), most=1) > 0
                        keep &= known
                        keep[1:] &= known[:-1]
                    yield from counts.add(found[keep])
            yield from counts.rows()

        model.grams[n] = cut(map_groups(map_batches(rows, count_grams, schema), "bucket", merge_grams, "bucket int, bits binary, kept long"), f"lm-filter-{n}")
        bits_before = model.grams[n].agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
        model.size += bits_before
        if shorter is not None:
            shorter.destroy()
    return model


def _estimates(levels: np.ndarray) -> np.ndarray:
    """The least count that has the level."""
    return np.where(levels > 0, np.ceil(LEAST * BASE ** (levels - 1) - 1e-6), 0.0)


def _most(levels: np.ndarray) -> np.ndarray:
    """The largest count that has the level; 0 if there is none."""
    return np.where(levels > 0, np.ceil(LEAST * BASE**levels - 1e-6) - 1, 0.0)


def _probabilities(counts: np.ndarray, levels: dict[int, np.ndarray], bounds: np.ndarray, tokens: int, distinct: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's and the model's probability of the token at each position; that of the opening edge has no meaning."""
    base = (counts + A) / (tokens + A * (distinct + 1))
    p = base.copy()
    history = np.zeros(len(counts))
    history[1:] = counts[:-1]
    place = np.arange(len(counts)) - np.repeat(bounds[:-1], np.diff(bounds))
    for n, found in levels.items():
        found = found.astype(np.float64)
        p = np.where(place >= n - 1, (np.minimum(_estimates(found), history) + MU * p) / (history + MU), p)
        most = np.minimum(_most(found), history)
        history = np.zeros(len(counts))
        history[1:] = most[:-1]
    return base, p


def _scores(counts: np.ndarray, levels: dict[int, np.ndarray], bounds: np.ndarray, tokens: int, distinct: int) -> tuple:
    """n_tokens, n_known, base_score and score of each text from what was found for each position."""
    firsts = bounds[:-1]
    start = np.zeros(len(counts), bool)
    start[firsts] = True
    log_base, log_p = (np.log10(x) for x in _probabilities(counts, levels, bounds, tokens, distinct))
    log_base[start] = log_p[start] = 0
    known = (counts > 0) & ~start
    total = lambda x: np.add.reduceat(x, firsts) if len(firsts) else x[:0]
    return np.diff(bounds) - 1, total(known.astype(np.int64)), total(log_base), total(log_p)


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens (long), base_score and score (double) of every document."""
    context, orders = documents.sparkSession.sparkContext, list(model.grams)
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    tokens, distinct = model.tokens, model.distinct
    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
            *(T.StructField(n, T.DoubleType()) for n in ("base_score", "score")),
        ]
    )

    def look_up(part: Part, piece):
        hashes, bounds = texts.tokens(piece, edge=EDGE)
        return bounds, part.word_counts(hashes), {n: part.levels(n, _grams(hashes, bounds, n)) for n in orders}

    def scored(ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate([x[i] for x in found]) if found else np.empty(0) for i in range(4)]
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        a, b, c, d = (pa.array(v, k) for v, k in zip(columns, kinds, strict=True))
        return pa.RecordBatch.from_arrays([ids, a, b, pa.array([tokens] * len(ids), pa.int64()), c, d], names=schema.names)

    if model.parts() == 1:
        sent = context.broadcast(model.part(0))

        def run(batches):
            for batch in batches:
                found = []
                for piece in texts.pieces(texts.column(batch, "text")):
                    bounds, counts, levels = look_up(sent.value, piece)
                    found.append(_scores(counts, levels, bounds, tokens, distinct))
                yield scored(batch.column(0), found)

        return map_batches(rows, run, schema).withColumnRenamed("id", id_column)

    carried = rows.withColumns({"counts": F.lit(None).cast("binary"), "levels": F.lit(None).cast("binary")})
    for number in range(model.parts()):
        sent = context.broadcast(model.part(number))

        def gather(batches, sent=sent):
            for batch in batches:
                at, counts_out, levels_out = 0, [], []
                for piece in texts.pieces(texts.column(batch, "text")):
                    bounds, counts, levels = look_up(sent.value, piece)
                    for i in range(len(piece)):
                        lo, hi = bounds[i], bounds[i + 1]
                        mine = [counts[lo:hi], np.concatenate([np.empty(0, np.uint8), *(levels[n][lo:hi] for n in orders)])]
                        for k, kind, out in ((2, np.int64, counts_out), (3, np.uint8, levels_out)):
                            before = batch.column(k)[at]
                            out.append((mine[k - 2] + (np.frombuffer(before.as_buffer(), kind) if before.is_valid else 0)).astype(kind).tobytes())
                        at += 1
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts_out, pa.binary()), pa.array(levels_out, pa.binary())], names=["id", "text", "counts", "levels"])

        carried = cut(map_batches(carried, gather, carried.schema), f"lm-part-{number}")
        sent.destroy()

    def finish(batches):
        for batch in batches:
            found = []
            for c, found_levels in zip(batch.column(1), batch.column(2), strict=True):
                counts = np.frombuffer(c.as_buffer(), np.int64)
                each = np.frombuffer(found_levels.as_buffer(), np.uint8).reshape(len(orders), -1)
                found.append(_scores(counts, dict(zip(orders, each, strict=True)), np.array([0, len(counts)]), tokens, distinct))
            yield scored(batch.column(0), found)

    return map_batches(carried.select("id", "counts", "levels"), finish, schema).withColumnRenamed("id", id_column)
