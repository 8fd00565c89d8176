"""A training corpus from raw documents.

Rejected quality, rejected rules, near copies and benchmark leaks go, in this order; then the sources are mixed.
Every stage sees all that the one before it kept, and learns or counts on that alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakerecon.llm import bottomk, factorisation, lsa, mixing, rule_ledger
from lakerecon.llm.frames import cut

#: Words of a shingle and percent of similarity from which documents are near copies.
WIDTH = 5
PERCENT = 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a factorisation machine, fitted on the labelled ones among them, scores at least 0.3."""
    model = factorisation.fit(docs, _table(spark, sf_dir, "labels"))
    return factorisation.keep(docs, model)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy."""
    return rule_ledger.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest doc_id."""
    return bottomk.deduplicate(docs, width=WIDTH, percent=PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return lsa.keep(docs, _table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as systematic sampling takes it, numbered by ``copy``."""
    return mixing.mixture(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_duplicates),
    ("latent_decontamination", decontamination),
    ("source_mixing", source_mixing),
]

#: The classifier and the latent search cannot be said in SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``; what the others keep is written to the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
