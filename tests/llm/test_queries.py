"""The registered queries on the small test tables, against SQL or plain versions, and the pipeline stage by stage."""

import zlib

import corpus_pipeline
import numpy as np
import plain
import pytest
from oracle import compare, connect

from lakerecon.llm import queries

DATA = "/root/testdata/sf0.01"
QUERIES, SQL = queries.registered(), queries.oracles()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").collect()


def remainder(key, n):
    return zlib.crc32(str(key).encode()) % n


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    problem, rows = compare(QUERIES[name](spark, DATA), con, SQL[name])
    assert problem is None and rows > 0


def test_op1(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op1_log_frequency_lm"](spark, DATA).collect()}
    training = [d.text for d in documents if remainder(d.doc_id, 10)]
    for d, wanted in zip(documents, plain.unigram_scores([d.text for d in documents], training), strict=True):
        r = got[d.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == wanted[:3] and abs(r.base_score - wanted[3]) < 1e-6 * (1 + abs(wanted[3]))
        assert r.held_out == (remainder(d.doc_id, 10) == 0)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op6(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = QUERIES["op6_factorisation_machine"](spark, DATA).collect()
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(got) == 1000 and all(r.held_out == (remainder(r.doc_id, 5) == 0) and r.predicted == int(r.score >= 0.3) for r in got)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9


def test_op8(spark, documents):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    wanted = {(d.doc_id, i.item_id) for d in documents for i in items if plain.contains(d.text, i.text)}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_latent_decontamination"](spark, DATA).collect()}
    assert wanted and wanted <= got and len(got) <= len(wanted) + 2


def test_op9(spark, documents):
    lang = {d.doc_id: d.lang for d in documents}
    got = QUERIES["op9_string_kernel"](spark, DATA).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang) and all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_op10(spark, documents):
    rows = [(d.doc_id, d.text) for d in documents]
    wanted = {key: found for (key, _), found in zip(rows, plain.components(rows, 2, 80).values())}
    got = QUERIES["op10_minhash_near_dedup"](spark, DATA).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_pipeline_stages(spark, documents):
    """Each stage on all that the one before it kept."""
    docs, columns = spark.read.parquet(f"{DATA}/documents.parquet"), list(documents[0].asDict())
    seen = [{d.doc_id: d.text for d in documents}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, DATA), f"test-{name}")
        assert docs.columns == columns
        rows = docs.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        seen.append({r.doc_id: r.text for r in rows})
        assert set(seen[-1]) <= set(seen[-2]) and all(seen[-2][k] == t for k, t in seen[-1].items())
    scored, ruled, single, clean = seen[1:]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert np.mean([(k in scored) == bool(q) for k, q in labels.items()]) > 0.95
    assert all((n := plain.quality_numbers(t))[0] >= 50 and 100 * n[4] <= 50 * n[0] for t in ruled.values())
    rows = list(ruled.items())
    groups = [found[1] for found in plain.components(rows, corpus_pipeline.WIDTH, corpus_pipeline.PERCENT).values()]
    assert set(single) == set(groups)
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    leaks = {k for k, t in single.items() if any(plain.contains(t, i) for i in items)}
    assert leaks and not leaks & set(clean) and len(set(single) - leaks - set(clean)) <= 2
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert mixed.columns == [*columns, "copy"]
    rows = mixed.collect()
    assert {r.doc_id for r in rows} <= set(clean) and len({(r.doc_id, r.copy) for r in rows}) == len(rows) and max(r.copy for r in rows) <= 2
    total = sum(len(plain.words(t)) for t in clean.values())
    assert abs(sum(len(plain.words(r.text)) for r in rows) - 1.5 * total) < 0.1 * total
