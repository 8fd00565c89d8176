"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of all words over all documents, by hash in SLOTS slots, give the inverse
   document frequencies. A passage is a vector sqrt(tf) * idf.
2. The benchmark is cut into passages of up to PASSAGE words. A distributed randomised SVD of their matrix (random
   range finder, one power iteration, tasks add up their share of A'A Q) gives term vectors. Blocks have at most RANK
   passages, so that the space is complete and the latent step loses nothing whatever the size of the benchmark.
3. Every window of WINDOW words, at each STRIDE words of every whole document, is projected and compared with all
   benchmark passages by cosine; passages of fewer words than a bound of SHORTER also with the smaller windows that
   belong to it. Items of fewer than EXACT words that stand in a document word by word are candidates whatever the cosine. Both norms are those of the full vectors, so the cosine in the latent space
   never exceeds what the shared words allow, and windows whose words of the benchmark weigh less than
   COSINE can be left out without a loss before anything is projected.
4. For each candidate the longest common subsequence of the item's words and the words around the window decides:
   a share of VERBATIM or more is a leak; from PARAPHRASE on it is one if the answer (what follows the
   last question mark or line break of the item, else its last third) is found to at least ANSWER.

Benchmark items are worked off in blocks of up to ITEMS; up to BLOCKS blocks share one pass over the documents and one
broadcast, whose size is bounded by these numbers. Case and ASCII punctuation do not count. Items of fewer than SHORT words must be
found completely. Null and empty texts and items match nothing; repeated rows and items match as often as
they occur; null ids are reported as null. Other columns are not looked at, or passed through by ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import cut, map_batches, map_groups

SLOTS = 1 << 18
SLICES = 32
PASSAGE = 64
RANK = 256
WINDOW = 32
STRIDE = 16
COSINE = 0.35
VERBATIM = 0.8
PARAPHRASE = 0.6
ANSWER = 0.5
SHORT = 8
#: (words, window): passages of fewer words are also compared with windows of this length, at each half of it.
SHORTER = ((24, 16), (12, 8))
#: Items of fewer words are also looked up word by word.
EXACT = 24
ITEMS = 512
BLOCKS = 8

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLAIN = bytes(32 if c < 0x80 and not chr(c).isalnum() else c for c in range(256))


def _words(found: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words with case folded, whatever the alphabet, without ASCII punctuation."""
    return texts.tokens([None if t is None else t.decode(errors="replace").casefold().encode().translate(_PLAIN) for t in found], lower=False)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int32)


def _summed(parts: DataFrame, kind: type) -> np.ndarray:
    """The sum over tasks of arrays that they give in slices (slice, values)."""

    def add(table: pa.Table) -> pa.Table:
        total = None
        for value in table.column("values"):
            x = np.frombuffer(value.as_buffer(), kind)
            total = x.copy() if total is None else total + x
        return pa.table({"slice": table.column("slice").slice(0, 1), "values": pa.array([total.tobytes()], pa.binary())})

    got = sorted(map_groups(parts, "slice", add, "slice int, values binary").collect())
    return np.concatenate([np.frombuffer(r["values"], kind) for r in got]) if got else np.empty(0, kind)


def _slices(total: np.ndarray, number: int) -> pa.RecordBatch:
    cuts = np.array_split(total.ravel(), number)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(number), pa.int32()), pa.array([c.tobytes() for c in cuts], pa.binary())], names=["slice", "values"]
    )


def inverse_frequencies(documents: DataFrame, text_column: str = "text") -> np.ndarray:
    """log(1 + documents / documents with a word) for each slot, over all documents."""
    rows = documents.select(F.col(text_column).cast("string").alias("text"))

    def run(batches):
        total = np.zeros(SLOTS + SLICES, np.int64)
        for batch in batches:
            for piece in texts.pieces(texts.column(batch, "text")):
                hashes, bounds = _words(piece)
                owner = np.repeat(np.arange(len(piece), dtype=np.int64), np.diff(bounds))
                pairs = np.sort((owner << 18) | _slots(hashes))
                first = np.ones(len(pairs), bool)
                first[1:] = pairs[1:] != pairs[:-1]
                total[:SLOTS] += np.bincount(pairs[first] & (SLOTS - 1), minlength=SLOTS)
                total[SLOTS] += len(piece)
        yield _slices(total, SLICES)

    found = _summed(map_batches(rows, run, "slice int, values binary"), np.int64)
    documents_seen = max(1, int(found[SLOTS])) if len(found) else 1
    counts = np.maximum(found[:SLOTS], 1) if len(found) else np.ones(SLOTS)
    return np.log1p(documents_seen / counts).astype(np.float32)


def _answer(text: bytes) -> int:
    """Words before the answer of an item."""
    at = max(text.rstrip().rfind(b"?"), text.rstrip().rfind(b"\n"))
    words = len(_words([text])[0])
    before = len(_words([text[: at + 1]])[0]) if at >= 0 else 0
    return before if 0 < before < words else words - max(1, words // 3)


@dataclass
class Index:
    """One block of the benchmark: sorted term hashes with their vectors, passages with theirs, and the items.

    An item of more passages than a space can have is in several blocks, with the same number.
    """

    terms: np.ndarray
    vectors: np.ndarray
    passages: np.ndarray
    owner: np.ndarray
    items: list
    numbers: list[int]
    masks: list[dict[int, int]]
    sizes: list[int]
    before: list[int]
    marked: np.ndarray
    #: (window, stride, passages, for each term its largest share in any of them as the latent space gives it).
    kinds: list[tuple[int, int, np.ndarray, np.ndarray]]
    #: Short items by the hash of all their words: lengths, and item positions by (length, hash).
    seeds: np.ndarray
    exact: dict[tuple[int, int], list[int]]


def _vector(columns: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Distinct columns, sqrt(tf) * idf, and its squared norm."""
    found, counts = np.unique(columns, return_counts=True)
    values = np.sqrt(counts) * weights[found]
    return found, values, float((values**2).sum())


def _randomised_svd(passages: DataFrame, terms: np.ndarray, weights: np.ndarray, rank: int, seed: int = 11) -> np.ndarray:
    """Right singular vectors (terms x rank) of the passages' matrix; tasks hold rows, the driver terms x rank numbers."""
    rank = min(rank, len(terms))
    context = passages.sparkSession.sparkContext

    def gram_times(basis: np.ndarray) -> np.ndarray:
        sent = context.broadcast((terms, weights, basis))

        def run(batches):
            known, idf, q = sent.value
            total = np.zeros_like(q)
            for batch in batches:
                for value in batch.column(0):
                    at, x, norm = _vector(np.searchsorted(known, np.frombuffer(value.as_buffer(), np.uint64)), idf)
                    x = (x / np.sqrt(norm)).astype(np.float32)
                    total[at] += np.outer(x, x @ q[at])
            yield _slices(total, SLICES)

        out = _summed(map_batches(passages.select("words"), run, "slice int, values binary"), np.float32).reshape(basis.shape)
        sent.destroy()
        return out

    basis = np.random.default_rng(seed).normal(size=(len(terms), rank)).astype(np.float32)
    for _ in range(2):
        basis = np.linalg.qr(gram_times(basis))[0].astype(np.float32)
    _, rotation = np.linalg.eigh(basis.T @ gram_times(basis))
    return (basis @ rotation[:, ::-1]).astype(np.float32)


def indexes(benchmark: DataFrame, idf: np.ndarray, id_column: str = "item_id", text_column: str = "text", rank: int = RANK) -> list[Index]:
    """The benchmark in blocks of about ITEMS items, each with its own latent space."""
    rows = benchmark.select(F.col(id_column).alias("item"), F.col(text_column).cast("string").alias("text")).filter("text IS NOT NULL")
    blocks = -(-rows.count() // ITEMS)
    rows = cut(rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(max(1, blocks))).cast("int")), "lsa-items")
    made, count = [], 0
    for number in range(blocks):
        items = [(r["item"], r["text"].encode()) for r in rows.filter(F.col("block") == number).orderBy("item", "text").collect()]
        part: list[tuple] = []
        for item, text in items:
            words = _words([text])[0]
            starts = range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2) if len(words) else []
            for at in starts:
                if len(part) == rank:
                    made.append(_index(rows.sparkSession, part, idf))
                    part = []
                part.append((count, item, text, words, words[at : at + PASSAGE]))
            count += 1
        if part:
            made.append(_index(rows.sparkSession, part, idf))
    return made


def _index(spark: SparkSession, part: list[tuple], idf: np.ndarray) -> Index:
    """The index of passages (number of the item, item, its text, its words, words of the passage)."""
    terms = np.unique(np.concatenate([p[4] for p in part]))
    weights = idf[_slots(terms)]
    passages = spark.createDataFrame([(bytearray(p[4].tobytes()),) for p in part], "words binary").repartition(4)
    vectors = _randomised_svd(passages, terms, weights, len(part))
    numbers, items, sizes, before, masks, latent, owner = [], [], [], [], [], [], []
    exact: dict[tuple[int, int], list[int]] = {}
    for number, item, text, words, passage in part:
        if not numbers or numbers[-1] != number:
            mask: dict[int, int] = {}
            for j, word in enumerate(words.tolist()):
                mask[word] = mask.get(word, 0) | (1 << j)
            if len(words) < EXACT:
                exact.setdefault((len(words), int(_Spans(words)(0, len(words)))), []).append(len(numbers))
            numbers.append(number)
            items.append(item)
            sizes.append(len(words))
            before.append(_answer(text))
            masks.append(mask)
        found, x, norm = _vector(np.searchsorted(terms, passage), weights)
        latent.append(x @ vectors[found] / np.sqrt(norm))
        owner.append(len(numbers) - 1)
    marked = np.zeros(SLOTS, bool)
    marked[_slots(terms)] = True
    latent, lengths = np.array(latent, np.float32), np.array([len(p[4]) for p in part])
    kinds = []
    for bound, window in ((PASSAGE + 1, WINDOW), *SHORTER):
        some = np.flatnonzero(lengths < bound)
        if len(some):
            most = np.concatenate([(vectors[i : i + 4096] @ latent[some].T).max(1) for i in range(0, len(terms), 4096)]).clip(0)
            kinds.append((window, STRIDE * window // WINDOW, some, most))
    seeds = np.array(sorted({size for size, _ in exact}), np.int64)
    return Index(terms, vectors, latent, np.array(owner), items, numbers, masks, sizes, before, marked, kinds, seeds, exact)


class _Spans:
    """One hash for each span of words, which depends on their order but not on where it starts."""

    def __init__(self, hashes: np.ndarray):
        power, back = (np.cumprod(np.full(len(hashes), x, np.uint64), dtype=np.uint64) for x in (_BASE, _INVERSE))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)))
        self.back = back

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.back[start]


def _windows(bounds: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of every window."""
    sizes = np.diff(bounds)
    per_text = np.where(sizes > 0, np.maximum(1, -(-(sizes - window) // stride) + 1), 0)
    owner = np.repeat(np.arange(len(sizes)), per_text)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = bounds[:-1][owner] + step * stride
    return owner, start, np.minimum(start + window, bounds[1:][owner])


def _subsequence(mask: dict[int, int], words: list[int], size: int) -> int:
    """Bits of the item's words that a longest common subsequence with ``words`` uses, as it is found word by word."""
    full = (1 << size) - 1
    left = full
    for word in words:
        if bits := mask.get(word):
            met = left & bits
            left = ((left + met) | (left - met)) & full
    return full & ~left


def _share(mask: dict[int, int], words: list[int], size: int, before: int) -> tuple[float, float]:
    """Shares of the item and of its answer that the words have in common with it, in order."""
    whole = _subsequence(mask, words, size).bit_count() / size
    answer = {w: b >> before for w, b in mask.items() if b >> before}
    return whole, _subsequence(answer, words, size - before).bit_count() / (size - before)


def _search(piece: list[bytes | None], blocks: list[Index], idf: np.ndarray, cosine: float) -> list[list[tuple]]:
    """For each text its leaks (item, cosine, share of the item, share of its answer, first word of the window)."""
    hashes, bounds = _words(piece)
    slots = _slots(hashes)
    weight = idf[slots].astype(np.float64)
    all_mass = np.concatenate(([0.0], np.cumsum(weight**2)))
    windows = {x: _windows(bounds, *x) for x in {kind[:2] for block in blocks for kind in block.kinds}}
    found: list[dict] = [{} for _ in piece]
    spans = None

    def check(block: Index, item: int, text: int, start: int, stop: int, cosine: float) -> None:
        size = block.sizes[item]
        around = hashes[max(bounds[text], start - size) : min(bounds[text + 1], stop + size)].tolist()
        whole, answer = _share(block.masks[item], around, size, block.before[item])
        leak = whole >= VERBATIM or whole >= PARAPHRASE and answer >= ANSWER
        if whole == 1.0 if size < SHORT else leak:
            hit = (whole, cosine, answer, int(start - bounds[text]))
            key = block.numbers[item]
            found[text][key] = max(found[text].get(key, (hit,))[0], hit), block.items[item]

    for block in blocks:
        column = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(block.marked[slots])
        at = np.minimum(np.searchsorted(block.terms, hashes[maybe]), len(block.terms) - 1)
        column[maybe] = np.where(block.terms[at] == hashes[maybe], at, -1)
        term_weights = idf[_slots(block.terms)]

        def projected(start: int, stop: int, block=block, column=column, term_weights=term_weights) -> np.ndarray:
            columns = column[start:stop]
            terms, x, _ = _vector(columns[columns >= 0], term_weights)
            return x @ block.vectors[terms] / np.sqrt(all_mass[stop] - all_mass[start])

        for window, stride, passages, most in block.kinds:
            owner, start, stop = windows[window, stride]
            gain = np.concatenate(([0.0], np.cumsum(np.where(column >= 0, weight * most[column], 0))))
            hot = np.flatnonzero(gain[stop] - gain[start] >= cosine * np.sqrt(all_mass[stop] - all_mass[start]))
            vectors = block.passages[passages]
            for lo in range(0, len(hot), 512):
                some = hot[lo : lo + 512]
                latent = np.zeros((len(some), block.vectors.shape[1]), np.float32)
                for i, w in enumerate(some):
                    latent[i] = projected(start[w], stop[w])
                close = latent @ vectors.T
                for i, p in zip(*np.nonzero(close >= cosine), strict=True):
                    w = some[i]
                    check(block, int(block.owner[passages[p]]), int(owner[w]), start[w], stop[w], float(close[i, p]))
        known = np.concatenate(([0], np.cumsum(column >= 0))) if len(block.seeds) else None
        for size in block.seeds.tolist():
            first = np.flatnonzero(known[size:] - known[:-size] == size) if len(hashes) >= size else np.empty(0, np.int64)
            if not len(first):
                continue
            text = np.searchsorted(bounds, first, side="right") - 1
            inside = first + size <= bounds[text + 1]
            first, text = first[inside], text[inside]
            if spans is None:
                spans = _Spans(hashes)
            for i, value in enumerate(spans(first, first + size).tolist()):
                for item in block.exact.get((size, value), ()):
                    if block.numbers[item] not in found[text[i]]:
                        passage = block.passages[int(np.flatnonzero(block.owner == item)[0])]
                        check(block, item, int(text[i]), first[i], first[i] + size, float(projected(first[i], first[i] + size) @ passage))
    return [[(item, hit[1], hit[0], hit[2], hit[3]) for hit, item in x.values()] for x in found]


def _passes(blocks: list[Index]) -> list[list[Index]]:
    """Up to BLOCKS blocks; more only where one item goes on from block to block."""
    groups: list[list[Index]] = []
    for block in blocks:
        if groups and (len(groups[-1]) < BLOCKS or groups[-1][-1].numbers[-1] == block.numbers[0]):
            groups[-1].append(block)
        else:
            groups.append([block])
    return groups


def leaks(
    documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", rank: int = RANK, cosine: float = COSINE,
) -> DataFrame:
    """One row per document and benchmark item found in it: ids, cosine, lcs_share, answer_share and first_word (of the window)."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField(id_column, rows.schema["id"].dataType),
            T.StructField(item_column, benchmark.schema[item_column].dataType),
            *(T.StructField(n, T.DoubleType()) for n in ("cosine", "lcs_share", "answer_share")),
            T.StructField("first_word", T.LongType()),
        ]
    )
    idf = inverse_frequencies(documents, text_column)
    out = documents.sparkSession.createDataFrame([], schema)
    for group in _passes(indexes(benchmark, idf, item_column, item_text, rank)):
        sent = documents.sparkSession.sparkContext.broadcast((group, idf))

        def run(batches, sent=sent, names=schema.names):
            blocks, weights = sent.value
            for batch in batches:
                ids, hits, at = [], [], 0
                for piece in texts.pieces(texts.column(batch, "text")):
                    for found in _search(piece, blocks, weights, cosine):
                        ids += [at] * len(found)
                        hits += found
                        at += 1
                columns = list(zip(*hits, strict=True)) or [[]] * 5
                kinds = [None if hits else pa.null(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(ids)), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names
                    )

        out = out.unionByName(map_batches(rows, run, schema))
    return out


def keep(
    documents: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
    rank: int = RANK, cosine: float = COSINE,
) -> DataFrame:
    """The documents without a leak, with the columns of the input."""
    idf = inverse_frequencies(documents, text_column)
    name = documents.columns[documents.columns.index(text_column)]
    out = documents
    for group in _passes(indexes(benchmark, idf, item_column, item_text, rank)):
        sent = documents.sparkSession.sparkContext.broadcast((group, idf))

        def run(batches, sent=sent):
            blocks, weights = sent.value
            for batch in batches:
                clean = [not x for piece in texts.pieces(texts.column(batch, name)) for x in _search(piece, blocks, weights, cosine)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = map_batches(out, run, documents.schema)
    return out
