"""A quality classifier: a factorisation machine on hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all pairwise
interactions of rank FACTORS at a cost that is linear in the features a document has.

The features of all documents are made in tasks, from whole texts. The model is fitted on the driver from
at most SAMPLE labelled rows, those with the smallest hashes of their ids; its size does not depend on the data.

Null and empty texts have structure features only, and a score like any other. Rows whose label is null
are not learned from; a document with several labels is learned with each. Without any label every score is 0.5. Null ids
are scored and not learned from. Null metadata has its own feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import map_batches

BUCKETS = 1 << 14
FACTORS = 8
SAMPLE = 8_000
EPOCHS = 12
THRESHOLD = 0.3

_LETTERS = bytes(range(97, 123))
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_HIGH = bytes(range(0x80, 0x100))
#: Statistics of structure, then three features for the metadata column.
STATISTICS = 13
META = 2
WIDTH = BUCKETS + STATISTICS + META


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


def _statistics(text: bytes, counts: np.ndarray, words: int) -> list[float]:
    size = max(1, len(text))
    without = lambda which: (size - len(text.translate(None, which))) / size if text else 0.0
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        np.log1p(words),
        np.log1p(len(text)),
        len(text) / max(1, words),
        without(_LETTERS),
        without(_CAPITALS),
        without(_DIGITS),
        without(_SYMBOLS),
        without(b"!"),
        without(_HIGH),
        without(b".,;:?"),
        len(counts) / max(1, words),
        float(counts.max()) / words if words else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]


def _features(batch: pa.RecordBatch):
    """For each piece of the batch: bucket numbers, their values and bounds by document, and the dense features."""
    meta = batch.column(batch.schema.get_field_index("meta")).to_numpy(zero_copy_only=False).astype(np.float64)
    row = 0
    for piece in texts.pieces(texts.column(batch, "text")):
        hashes, bounds = texts.tokens(piece)
        slots = (hashes >> np.uint64(50)).astype(np.int32)
        index, value, ends, dense = [], [], [0], []
        for i, text in enumerate(piece):
            found, counts = np.unique(slots[bounds[i] : bounds[i + 1]], return_counts=True)
            weight = np.log1p(counts)
            index.append(found)
            value.append(weight / max(1e-9, np.sqrt((weight**2).sum())))
            ends.append(ends[-1] + len(found))
            known = meta[row] == meta[row]
            dense.append(_statistics(text or b"", counts if len(counts) else np.zeros(1), int(bounds[i + 1] - bounds[i])) + [np.log1p(max(0.0, meta[row])) if known else 0.0, float(not known)])
            row += 1
        yield np.concatenate(index), np.concatenate(value).astype(np.float32), np.array(ends), np.array(dense, np.float32)


def _rows(documents: DataFrame, id_column: str, text_column: str, meta_column: str | None) -> DataFrame:
    meta = F.col(meta_column).try_cast("double") if meta_column else F.lit(None).cast("double")
    return documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), meta.alias("meta"))


def _joined(index, value, ends, dense, model: Model):
    """One sparse row per document, hashed words first, then the standardised statistics."""
    n, extra = len(dense), STATISTICS + META
    dense = np.clip((dense - model.centre) / model.scale, -4, 4) * 0.5
    sizes = np.diff(ends)
    starts = np.concatenate(([0], np.cumsum(sizes + extra)))[:-1]
    total = int(ends[-1]) + n * extra
    i, v = np.empty(total, np.int32), np.empty(total, np.float32)
    tail = (starts + sizes)[:, None] + np.arange(extra)
    head = np.ones(total, bool)
    head[tail.ravel()] = False
    i[head], v[head] = index, value
    i[tail.ravel()], v[tail.ravel()] = np.tile(np.arange(BUCKETS, WIDTH, dtype=np.int32), n), dense.ravel()
    return i, v, starts


def _margins(model: Model, i, v, starts):
    parts = model.factors[i] * v[:, None]
    sums = np.add.reduceat(parts, starts)
    pairs = 0.5 * ((sums**2).sum(1) - np.add.reduceat((parts**2).sum(1), starts))
    return model.bias + np.add.reduceat(model.weights[i] * v, starts) + pairs, sums


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(rows: list[tuple], seed: int) -> Model:
    """Adam on the logistic loss; ``rows`` hold buckets, values, dense features and label."""
    rng = np.random.default_rng(seed)
    extra = STATISTICS + META
    model = Model(0.0, np.zeros(WIDTH, np.float32), rng.normal(0, 0.05, (WIDTH, FACTORS)).astype(np.float32), np.zeros(extra, np.float32), np.ones(extra, np.float32))
    if not rows:
        return model
    dense, label = np.array([r[2] for r in rows]), np.array([r[3] for r in rows], np.float32)
    model.centre, model.scale = dense.mean(0), dense.std(0) + 1e-3
    state = {k: (np.zeros_like(a), np.zeros_like(a)) for k, a in (("w", model.weights), ("v", model.factors), ("b", np.zeros(1)))}
    step = 0

    def adam(k, gradient, rate):
        m, s = state[k]
        m += 0.1 * (gradient - m)
        s += 0.01 * (gradient**2 - s)
        return rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)

    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), 256):
            some, step = order[at : at + 256], step + 1
            ends = np.concatenate(([0], np.cumsum([len(rows[j][0]) for j in some])))
            i, v, starts = _joined(np.concatenate([rows[j][0] for j in some]), np.concatenate([rows[j][1] for j in some]), ends, dense[some], model)
            margin, sums = _margins(model, i, v, starts)
            error = ((_sigmoid(margin) - label[some]) / len(some)).astype(np.float32)
            which = np.repeat(np.arange(len(some)), np.diff(np.concatenate((starts, [len(i)]))))
            pull = error[which] * v
            gradient = np.empty_like(model.factors)
            for f in range(FACTORS):
                gradient[:, f] = np.bincount(i, pull * (sums[which, f] - model.factors[i, f] * v), WIDTH)
            model.factors -= adam("v", gradient + 1e-4 * model.factors, 0.01)
            model.weights -= adam("w", np.bincount(i, pull, WIDTH).astype(np.float32) + 1e-5 * model.weights, 0.02)
            model.bias -= float(adam("b", np.array([error.sum()]), 0.02)[0])
    return model


def fit(
    documents: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text",
    meta_column: str | None = "n_chars", sample: int = SAMPLE, seed: int = 7,
) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` (id, 0/1) whose documents are in ``documents``.

    An id that several documents have brings all of them; of what then is more than ``sample`` rows, those with the
    smallest hashes of id and features are taken.
    """
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("double").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    ids = documents.select(F.col(id_column).alias("id"))
    chosen = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id", "label").limit(sample)
    rows = _rows(documents, id_column, text_column, meta_column).join(F.broadcast(chosen), "id").select("id", "text", "meta", "label")

    def run(batches):
        for batch in batches:
            index, value, dense = [], [], []
            for i, v, ends, d in _features(batch):
                for j in range(len(d)):
                    index.append(i[ends[j] : ends[j + 1]].tobytes())
                    value.append(v[ends[j] : ends[j + 1]].tobytes())
                    dense.append(d[j].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), pa.array(index, pa.binary()), pa.array(value, pa.binary()), pa.array(dense, pa.binary()), batch.column(3)],
                names=["id", "buckets", "value", "dense", "label"],
            )

    featured = map_batches(rows.withColumn("id", F.col("id").cast("string")), run, "id string, buckets binary, value binary, dense binary, label double")
    found = featured.orderBy(F.xxhash64("id", "buckets", "dense"), "id", "label").limit(sample).collect()
    found.sort(key=lambda r: (r.id, r.label, r.buckets))
    return _fit([(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.value, np.float32), np.frombuffer(r.dense, np.float32), r.label) for r in found], seed)


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", meta_column: str | None = "n_chars") -> DataFrame:
    """id and score (double, 0 to 1) of every document."""
    rows = _rows(documents, id_column, text_column, meta_column)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [_sigmoid(_margins(sent.value, *_joined(*x, sent.value))[0]) for x in _features(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.empty(0), *scores]), pa.float64())], names=["id", "score"])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)


def keep(documents: DataFrame, model: Model, text_column: str = "text", meta_column: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with the columns of the input and in one pass over them."""
    one = documents.select(F.struct(*documents.columns).alias("row"), F.col(text_column).alias("text"), (F.col(meta_column) if meta_column else F.lit(None)).alias("meta"))
    return score(one, model, "row", "text", "meta").filter(F.col("score") >= threshold).select("row.*")
