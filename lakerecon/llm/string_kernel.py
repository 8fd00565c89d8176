"""Language identification by a string kernel.

K(s, t) = |grams(s) & grams(t)| / sqrt(|grams(s)| |grams(t)|), where grams(s) is the set of the 1 to
LONGEST byte n-grams present in the lower-cased text, everything but letters of ASCII and bytes from 0x80 on being blanks
(a blended-spectrum presence kernel; n-grams are hashed to GRAMS slots).

Nystroem: LANDMARKS texts, the same number of each language, give features K(x, L) K(L, L)^(-1/2); one
ridge regression per language, against the rest, is fitted on them. Both use a sample of about SAMPLE rows,
split evenly between languages, chosen by hash; everything else covers all texts, whole.

Scores of a batch are X P A: X says which n-grams a text has, P which of them a landmark has (both with
their norms), A holds the regressions. P A is multiplied once, so a text costs as many additions as it has
n-grams that any landmark has.

Null texts and texts without a letter get ``und`` and score 0. Rows with a null language teach nothing. If nothing
can be learned, every text is ``und``. Null and repeated ids are treated like any others. There should be at
most SAMPLE / 20 languages; beyond, the sample grows by 20 rows for each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import map_batches, small

LONGEST = 3
GRAMS = 1 << 18
LANDMARKS = 192
SAMPLE = 6_000
RIDGE = 1e-2
UNKNOWN = "und"

#: Bytes that a piece of a very long text has; pieces overlap, so no n-gram is lost.
_SPAN = 1 << 20
_BLANK = bytes(c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))
_present = np.zeros(GRAMS, bool)


@dataclass
class Model:
    languages: list[str]
    rows: np.ndarray
    weights: np.ndarray


def _has_letter(text: bytes) -> bool:
    if text.translate(None, bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122))):
        return True
    return any(c.isalpha() for c in text.decode(errors="replace"))


def grams(text: bytes) -> np.ndarray:
    """Slots of the n-grams present in a whole text, ascending."""
    plain = b" " + b" ".join(text.decode(errors="replace").lower().encode().translate(_BLANK).split()) + b" "
    codes = np.frombuffer(plain, np.uint8)
    for at in range(0, len(codes), _SPAN):
        part = codes[at : at + _SPAN + LONGEST - 1].astype(np.uint32)
        joined = part
        for n in range(1, LONGEST + 1):
            if n > 1:
                joined = joined[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :]
            _present[((joined + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - 18)] = True
    found = np.flatnonzero(_present)
    _present[found] = False
    return found.astype(np.int32)


def _kernel(one: list[np.ndarray], rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of the table's rows over the n-grams of each text, divided by the norm of the text."""
    out = np.zeros((len(one), table.shape[1]), np.float32)
    for i, found in enumerate(one):
        at = rows[found]
        out[i] = table[at[at >= 0]].sum(0) / np.sqrt(max(1, len(found)))
    return out


def _fit(sample: list[tuple[str, np.ndarray]]) -> Model:
    languages = sorted({lang for lang, _ in sample})
    if not languages:
        return Model([], np.full(GRAMS, -1, np.int32), np.zeros((1, 0), np.float32))
    marks: list[np.ndarray] = []
    for lang in languages:
        marks += [g for x, g in sample if x == lang][: max(1, LANDMARKS // len(languages))]
    used = np.unique(np.concatenate(marks))
    rows = np.full(GRAMS, -1, np.int32)
    rows[used] = np.arange(len(used))
    table = np.zeros((len(used), len(marks)), np.float32)
    for j, found in enumerate(marks):
        table[rows[found], j] = 1 / np.sqrt(len(found))
    own, vectors = np.linalg.eigh(_kernel(marks, rows, table).astype(np.float64))
    keep = own > 1e-6 * own.max()
    whiten = vectors[:, keep] / np.sqrt(own[keep])
    features = np.hstack([_kernel([g for _, g in sample], rows, table) @ whiten, np.ones((len(sample), 1))])
    wanted = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in sample])
    share = 1 / np.array([sum(lang == x for x, _ in sample) for lang, _ in sample])
    gram = (features * share[:, None]).T @ features + RIDGE / len(languages) * np.diag([*np.ones(features.shape[1] - 1), 0])
    solved = np.linalg.lstsq(gram, (features * share[:, None]).T @ wanted, rcond=None)[0]
    weights = np.vstack([table @ (whiten @ solved[:-1]), solved[-1:]])
    return Model(languages, rows, weights.astype(np.float32))


def fit(documents: DataFrame, text_column: str = "text", lang_column: str = "lang", key: Column | None = None, sample: int = SAMPLE) -> Model:
    """Learn from the documents with a non-null language; ``key`` and the text decide which fall into the sample.

    Rows that agree in both count once in the sample, so it stays as small as stated whatever is repeated.
    """
    key = F.xxhash64(F.col(text_column)) if key is None else F.xxhash64(key, F.col(text_column))
    rows = documents.select(F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang"), key.alias("key"))
    rows = rows.filter("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.groupBy("lang").count()
    languages = max(1, counted.count())
    each = max(20, sample // languages)
    chance = F.pmod(F.col("key"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(small(counted), "lang").filter(chance * F.col("count") < each).select("lang", "key", "text").dropDuplicates(["lang", "key"])

    def run(batches):
        for batch in batches:
            found = [grams(t) if _has_letter(t) else None for t in texts.column(batch, "text")]
            lists = pa.array([None if g is None else g.tobytes() for g in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["lang", "key", "grams"])

    got = map_batches(chosen, run, "lang string, key long, grams binary").filter("grams IS NOT NULL").collect()
    got.sort(key=lambda r: (r.lang, r.key, r.grams))
    return _fit([(r.lang, np.frombuffer(r.grams, np.int32)) for r in got])


def predict(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, lang_pred and score (0 to 1: 0.5 stands for a margin of 0) of every document."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        learned = sent.value
        for batch in batches:
            all_texts = texts.column(batch, "text")
            known = [bool(learned.languages) and bool(t) and _has_letter(t) for t in all_texts]
            names, scores = [UNKNOWN] * len(all_texts), np.zeros(len(all_texts))
            at = [i for i, x in enumerate(known) if x]
            for lo in range(0, len(at), 256):
                some = at[lo : lo + 256]
                margins = _kernel([grams(all_texts[i]) for i in some], learned.rows, learned.weights[:-1]) + learned.weights[-1]
                for i, best, top in zip(some, margins.argmax(1), margins.max(1), strict=True):
                    names[i], scores[i] = learned.languages[best], min(1.0, max(0.0, (1 + float(top)) / 2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    schema = T.StructType(
        [T.StructField("id", rows.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)
