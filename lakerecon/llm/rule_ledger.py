"""A ledger of quality rules: every rule is evaluated once, its failure is one bit, its measurement stays.

``measure`` reads whole texts once and gives the measurements of each document. ``ledger`` adds
``fail_bits``: bit i is set if rule i of RULES fails. A policy is a named set of rules, kept by version;
applying one, or asking what would change without one of its rules, only looks at the bits. Texts are
not read again.

Null and empty texts measure 0 everywhere and fail ``few_words``. Rows with null or repeated ids are measured
like any others, one row out for one row in. Other columns of the input are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import map_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals")

#: Rule i owns bit i. Append new rules; never renumber.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("duplicate_lines", "n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines"),
    ("capitals", "100 * n_capitals > 50 * n_letters"),
    ("long_words", "word_chars > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
)

BASE = ("few_words", "repeated_windows")

POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"

_BLANKS = b" \t\n\x0b\x0c\r"
_NOT_STARTS = bytes(range(0x80, 0xC0)) + _BLANKS
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(65, 91))
_LETTERS = _CAPITALS + bytes(range(97, 123))


def _repeated(windows: np.ndarray, words: int) -> int:
    """Words that lie in a 3-word window found twice or more."""
    ordered = np.sort(windows)
    if len(ordered) < 2 or not (twice := ordered[1:] == ordered[:-1]).any():
        return 0
    marked = np.isin(windows, ordered[1:][twice])
    inside = np.zeros(words, bool)
    for j in range(3):
        inside[j : j + len(windows)] |= marked
    return int(inside.sum())


def _lines(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def measure(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and MEASURES, all long, of every document."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            found = []
            for piece in texts.pieces(texts.column(batch, "text")):
                hashes, bounds = texts.tokens(piece, lower=False)
                windows, at = texts.ngrams(hashes, bounds, 3)
                for i, text in enumerate(piece):
                    text, words = text or b"", int(bounds[i + 1] - bounds[i])
                    found.append(
                        (
                            words,
                            len(text.translate(None, _NOT_STARTS)),
                            len(text) - len(text.translate(None, _SYMBOLS)),
                            *_lines(text),
                            _repeated(windows[at[i] : at[i + 1]], words),
                            len(text) - len(text.translate(None, _LETTERS)),
                            len(text) - len(text.translate(None, _CAPITALS)),
                        )
                    )
            columns = np.array(found, np.int64).reshape(-1, len(MEASURES)).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["id", *MEASURES])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(m, T.LongType()) for m in MEASURES)])
    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)


def mask(rules: tuple[str, ...]) -> int:
    names = [name for name, _ in RULES]
    return sum(1 << names.index(rule) for rule in rules)


def ledger(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The measurements and ``fail_bits`` of every document."""
    bits: Column = F.lit(0).cast("long")
    for i, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(documents, id_column, text_column).withColumn("fail_bits", bits)


def passes(rules: tuple[str, ...], bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask(rules))) == 0


def apply_policies(kept: DataFrame, versions: list[str] | None = None) -> DataFrame:
    """The ledger with one boolean ``kept_<version>`` for each policy."""
    return kept.withColumns({f"kept_{v}": passes(POLICIES[v]) for v in versions or list(POLICIES)})


def ablations(kept: DataFrame, version: str = CURRENT, by: list[str] | None = None) -> DataFrame:
    """What each rule of a policy does, for all documents or for each value of ``by``.

    Per rule: documents that fail it, those that fail nothing else of the policy (they would stay without it), what
    the policy keeps, what it would keep without the rule, and ``with_bits``, the union of the bits that
    fail together with it. Documents are first counted by their bits, of which there are few.
    """
    by, whole = by or [], mask(POLICIES[version])
    counted = kept.groupBy(*by, F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).cast("long").alias("bit")) for r in POLICIES[version]))
    each = counted.select("*", F.explode(rules).alias("r")).select(*by, "bits", "n", "r.rule", "r.bit")
    fails, alone = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == F.col("bit")
    clean = F.col("bits") == 0
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    return each.groupBy(*by, "rule").agg(
        count(fails).alias("failing"),
        count(alone).alias("failing_alone"),
        count(clean).alias("kept"),
        count(clean | alone).alias("kept_without"),
        F.coalesce(F.bit_or(F.when(fails, F.col("bits"))), F.lit(0).cast("long")).alias("with_bits"),
    )


def keep(documents: DataFrame, version: str = CURRENT, text_column: str = "text") -> DataFrame:
    """The documents that pass a policy, with the columns of the input and in one pass over them."""
    names = [f"_c{i}" for i in range(len(documents.columns))]
    numbered = documents.toDF(*names)
    found = _beside(numbered, names[documents.columns.index(text_column)])
    bits = F.lit(False)
    for rule, fails in RULES:
        if rule in POLICIES[version]:
            bits = bits | F.expr(fails)
    return found.filter(~bits).select(*names).toDF(*documents.columns)


def _beside(documents: DataFrame, text_column: str) -> DataFrame:
    """All columns of the documents, followed by MEASURES."""
    one = documents.select(F.struct(*documents.columns).alias("row"), F.col(text_column).alias("text"))
    return measure(one, "row", "text").select("row.*", *MEASURES)
