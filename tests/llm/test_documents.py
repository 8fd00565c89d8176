"""Operators on documents, against plain versions and on odd rows."""

from collections import Counter

import numpy as np
import plain
import pytest
from plain import prose
from pyspark.sql import functions as F

from lakerecon.llm import bottomk, factorisation, lm_scoring, lsa, mixing, rule_ledger, string_kernel


@pytest.fixture(scope="session")
def odd_rows():
    """Ids and texts with nulls, empty and very long texts, copies, near copies, ties and repeated rows."""
    base = prose(1, 120)
    near = [" ".join(w if i % 40 != k else "changed" + str(k) for i, w in enumerate(base.split())) for k in range(12)]
    rows = [(i, prose(100 + i, 5 + 20 * i % 90)) for i in range(20)]
    rows += [(100 + i, t) for i, t in enumerate(near)] + [(200, base), (201, base.upper()), (99, base)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "one"), (305, "One two"), (None, base), (None, None)]
    rows += [(400, prose(7, 30_000)), (401, prose(7, 30_000) + " end"), (402, "x" * 300_000), (5, rows[5][1]), (5, rows[5][1])]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The same as a table whose other columns have the names that operators use."""
    clash = [(i, t, "node", 1, "x", 2.0, "k") for i, t in odd_rows]
    return spark.createDataFrame(clash, "doc_id long, text string, node string, n int, value string, score double, id string").repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


# near duplicates


@pytest.mark.parametrize("width", [2, 5])
def test_components_are_those_of_all_pairs(odd, odd_rows, width):
    wanted = Counter((key, *found) for (key, _), found in zip(odd_rows, plain.components(odd_rows, width, 80).values()))
    got = Counter(map(tuple, bottomk.near_duplicates(odd, width=width).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == wanted


def test_small_blocks_give_the_same(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(bottomk, "SKETCHES", 2)
    monkeypatch.setattr(bottomk, "BLOCK", 300)
    wanted = {key: found[1] for (key, _), found in zip(odd_rows, plain.components(odd_rows, 2, 80).values())}
    assert {r.doc_id: r.component_id for r in bottomk.near_duplicates(odd, width=2).collect()} == wanted


def test_one_of_each_group_stays_once(odd, odd_rows):
    kept = bottomk.deduplicate(odd, width=5)
    assert kept.columns == odd.columns
    groups = plain.components(odd_rows, 5, 80)
    alone = {found[1] for (key, _), found in zip(odd_rows, groups.values()) if key is not None}
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(alone) and ids.count(None) == 2


def test_rows_of_a_repeated_id_are_judged_by_their_own_text(spark):
    base = prose(1, 120).split()
    near = [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in (0, 119)]
    rows = [(1, " ".join(base)), (2, near[0]), (2, prose(2, 90)), (2, prose(3, 90)), (2, prose(3, 90) + " "), (3, prose(4, 50)), (4, near[1])]
    rows += [(5, prose(5, 80)), (5, prose(5, 80) + " end"), (6, ""), (6, ""), (6, None), (None, prose(2, 90)), (None, " ".join(base))]
    docs = spark.createDataFrame([(t, "x", i) for i, t in rows], "text string, bottomk_node string, doc_id long").repartition(3)
    kept = bottomk.deduplicate(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text and r.text.strip() if r.doc_id != 5 else None) for r in kept.collect())
    wanted = [rows[0], rows[2], rows[3], rows[5], (5, None), (6, ""), (6, None), *rows[-2:]]
    assert got == Counter(wanted)


def test_overlaps_of_many_sets_take_little_more_than_their_result():
    import tracemalloc

    rng = np.random.default_rng(5)
    core = rng.integers(0, 2**60, 560, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(core, 400, replace=False), rng.integers(0, 300, 80, dtype=np.uint64)])) for _ in range(1500)]
    tracemalloc.start()
    common = bottomk._overlaps(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for i, j in rng.integers(0, len(sets), (200, 2)):
        assert i == j or common[i, j] == len(np.intersect1d(sets[i], sets[j]))
    assert peak < 38 << 20


def test_lists_of_a_family_do_not_multiply_its_classes(spark, monkeypatch):
    """Forty lists of the same classes meet in the blocks as one list would."""
    monkeypatch.setattr(bottomk, "SKETCHES", 20)
    names = [bytes([i, 7]) for i in range(100)]
    rows = [(v, n, 50) for v in range(40) for n in names]
    members = spark.createDataFrame(rows, "value long, node binary, n long")
    sets = spark.createDataFrame([(n, n, np.arange(50 * (n[0] // 2), 50 * (n[0] // 2) + 50, dtype=np.uint64).tobytes()) for n in names], "node binary, comp binary, values binary")
    plans, group = [], bottomk.map_groups
    monkeypatch.setattr(bottomk, "map_groups", lambda df, *a: (plans.append(df), group(df, *a))[1])
    links = bottomk._in_blocks(members, sets, F.lit(1), 20, bottomk._sketch_forest).collect()
    assert {frozenset((r.a[0], r.b[0])) for r in links} == {frozenset((i, i + 1)) for i in range(0, 100, 2)}
    assert "Generate" in plans[0]._jdf.queryExecution().executedPlan().toString()


def test_forest_connects_what_links_connect():
    sets = [np.unique(np.array(x, np.uint64)) for x in ([*range(10)], [*range(1, 11)], [*range(2, 12)], [*range(50, 60)], [7], [7])]
    joined = {frozenset(p) for p in bottomk._forest(sets, 80)}
    assert joined == {frozenset((0, 1)), frozenset((1, 2)), frozenset((4, 5))} or joined == {frozenset((0, 1)), frozenset((0, 2)), frozenset((4, 5))}


@pytest.mark.parametrize("small, large", [(21, 26), (40, 50), (80, 100), (400, 500), (1600, 2000)])
def test_sets_that_contain_each_other_share_a_list(small, large):
    """At similarity 0.80; with a third of the retained values as anchors 1 in 700 of the largest had none in common."""
    rng = np.random.default_rng(small)
    for _ in range(6_000):
        values = rng.integers(0, 2**63, large, np.uint64)
        one, other = (bottomk._keys(np.sort(x)[: bottomk.K]) for x in (values, values[:small]))
        assert len(one) == len(np.unique(one)) and np.isin(one, other).any()


def test_less_than_the_bounds_allow_is_refused(odd):
    with pytest.raises(ValueError):
        bottomk.near_duplicates(odd, percent=70)


# rule ledger


def test_measurements(odd, odd_rows):
    got = rule_ledger.measure(odd).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert Counter(map(tuple, got)) == Counter((key, *plain.quality_numbers(text)) for key, text in odd_rows)


def test_policies_and_ablations_read_the_bits(spark):
    texts = [prose(1, 80), "a b c " * 40, "short", prose(2, 80) + " ###" * 40, "# " * 20, None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = rule_ledger.apply_policies(rule_ledger.ledger(docs)).orderBy("doc_id").collect()
    assert [r.kept_v1 for r in kept] == [True, False, False, True, False, False]
    assert [r.kept_v2 for r in kept] == [True, False, False, False, False, False]
    ablation = {r.rule: r for r in rule_ledger.ablations(rule_ledger.ledger(docs)).collect()}
    for rule, _ in rule_ledger.RULES:
        others = rule_ledger.mask(tuple(r for r, _ in rule_ledger.RULES if r != rule))
        assert ablation[rule].kept_without == sum(r.fail_bits & others == 0 for r in kept)
        assert ablation[rule].failing == sum(r.fail_bits & rule_ledger.mask((rule,)) != 0 for r in kept)
    assert [r.doc_id for r in rule_ledger.keep(docs).collect()] == [0]


# language model


def test_unigram_base_and_known_words(odd, odd_rows):
    model = lm_scoring.train(odd)
    got = lm_scoring.score(odd, model).collect()
    wanted = plain.unigram_scores([t for _, t in odd_rows], [t for _, t in odd_rows])
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == Counter(
        (key, *w[:3], round(w[3], 4)) for (key, _), w in zip(odd_rows, wanted)
    )
    assert all(r.score < 0 for r in got)


def test_parts_do_not_change_scores(odd):
    whole, parts = lm_scoring.train(odd), lm_scoring.train(odd, part_bytes=60_000)
    assert whole.parts() == 1 < parts.parts()
    one, other = (sorted(map(repr, lm_scoring.score(odd, m).collect())) for m in (whole, parts))
    assert one == other


def test_filter_holds_every_count_within_its_base(spark):
    docs = spark.createDataFrame([(i, "a b c" if i % 3 else "d e f") for i in range(90)], "doc_id long, text string")
    part = lm_scoring.train(docs).part(0)
    from lakerecon.llm import texts

    hashes, bounds = texts.tokens([b"a b", b"d e", b"b a"], edge=lm_scoring.EDGE)
    levels = part.levels(2, lm_scoring._grams(hashes, bounds, 2))
    estimates = lm_scoring._estimates(levels.astype(float))
    assert 60 / 1.5 <= estimates[2] <= 60 * 1.5 and 30 / 1.5 <= estimates[6] <= 30 * 1.5 and estimates[10] == 0


def test_frequent_grams_are_looked_for_once_and_at_one_level_only_where_asked(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "a b c d") for i in range(400)], "doc_id long, text string")
    part = lm_scoring.train(docs).part(0)
    from lakerecon.llm import texts

    hashes, bounds = texts.tokens([b"a b c d"] * 500 + [b"e f"], edge=lm_scoring.EDGE)
    grams, asked, probes = lm_scoring._grams(hashes, bounds, 2), [], lm_scoring._probes
    monkeypatch.setattr(lm_scoring, "_probes", lambda h, level: (asked.append((len(h), level)), probes(h, level))[1])
    every = part.levels(2, grams)
    assert asked[0][0] <= len(np.unique(grams)) < 20 and asked[-1][1] > 5
    asked.clear()
    assert (part.levels(2, grams, most=1) == np.minimum(every, 1)).all() and len(asked) == 1


def test_probabilities_after_a_history_add_up_to_one_at_most(spark):
    from lakerecon.llm import texts

    follow = [f"w{i}" for i in range(100)]
    rows = [f"h {w}" for w in follow for _ in range(2)] + [f"k h {w}" for w in follow[:30] for _ in range(5)] + ["k k k"] * 7
    model = lm_scoring.train(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    part = model.part(0)
    vocabulary = [*follow, "h", "k", "unknown"]
    assert model.distinct == len(vocabulary)
    for history in ("h", "k h", "k k", "k"):
        probes = [f"{history} {w}".encode() for w in vocabulary] + [history.encode()]
        hashes, bounds = texts.tokens(probes, edge=lm_scoring.EDGE)
        levels = {n: part.levels(n, lm_scoring._grams(hashes, bounds, n)) for n in model.grams}
        _, p = lm_scoring._probabilities(part.word_counts(hashes), levels, bounds, model.tokens, model.distinct)
        last = len(history.split()) + 1
        total = sum(p[lo + last] for lo in bounds[:-1])
        assert 0.5 < total <= 1.001


def test_scores_are_near_those_of_exact_counts(spark):
    from collections import defaultdict

    docs = [prose(i % 9, 60) for i in range(45)]
    model = lm_scoring.train(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    found = {r.doc_id: r.score for r in lm_scoring.score(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), model).collect()}
    edge, counts = lm_scoring.EDGE.decode(), defaultdict(int)
    lists = [[edge, *d.lower().split(), edge] for d in docs]
    for words in lists:
        for n in (1, 2, 3):
            for i in range(n == 1, len(words) - n + 1):
                counts[tuple(words[i : i + n])] += 1
    total = sum(c for k, c in counts.items() if len(k) == 1)
    distinct = sum(len(k) == 1 for k in counts)
    for i, words in enumerate(lists):
        low = high = 0.0
        for at in range(1, len(words)):
            p = q = (counts[(words[at],)] + 0.1) / (total + 0.1 * (distinct + 1))
            for n in (2, 3):
                if at >= n - 1:
                    gram, before = counts[tuple(words[at - n + 1 : at + 1])], counts[tuple(words[at - n + 1 : at])]
                    p, q = (gram / 1.5 + 8 * p) / (before * 1.5 + 8), (gram + 8 * q) / (before + 8)
            low, high = low + np.log10(p), high + np.log10(q)
        assert low - 0.01 <= found[i] <= high + 0.01


def test_likelier_text_scores_higher(spark):
    docs = spark.createDataFrame([(i, prose(i % 7, 200)) for i in range(40)], "doc_id long, text string")
    model = lm_scoring.train(docs)
    words = prose(3, 200).split()
    probe = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[::-1]))], "doc_id long, text string")
    found = {r.doc_id: r for r in lm_scoring.score(probe, model).collect()}
    assert found[1].score > found[2].score and abs(found[1].base_score - found[2].base_score) < 1e-6


# classifier


def test_quality_is_learned_and_held_out_rows_are_told(spark):
    good, bad = (lambda i: prose(i, 60)), (lambda i: "!! ".join(prose(i, 60).upper().split()))
    docs = spark.createDataFrame([(i, (bad if i % 4 == 0 else good)(i), 400 if i % 5 else None) for i in range(400)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = factorisation.fit(docs, labels)
    scores = {r.doc_id: r.score for r in factorisation.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert np.mean([(scores[i] >= 0.3) == (i % 4 > 0) for i in range(300, 400)]) > 0.97
    kept = factorisation.keep(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.3}


def test_linear_time_identity():
    rng = np.random.default_rng(0)
    width = factorisation.WIDTH
    model = factorisation.Model(0.3, rng.normal(size=width), rng.normal(size=(width, 3)), None, None)
    i, x = np.array([1, 5, 9]), rng.normal(size=3)
    pairs = sum(model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a in range(3) for b in range(a))
    got, _ = factorisation._margins(model, i, x, np.array([0]))
    assert np.isclose(got[0], 0.3 + model.weights[i] @ x + pairs)


def test_classifier_without_labels_and_on_odd_rows(spark, odd, odd_rows):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = factorisation.score(odd, factorisation.fit(odd, labels, meta_column="n"), meta_column="n").collect()
    assert len(found) == len(odd_rows) and {round(r.score, 1) for r in found} == {0.5}


# languages


def test_language_of_unseen_texts(spark):
    kinds = {"xa": "the and ing tion with of", "xb": "der die und schen keit ß", "xc": "les des une ê ment é"}
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(kinds[k].split(), 40)), k) for i, k in enumerate(list(kinds) * 60)]
    docs = spark.createDataFrame(rows + [(900, "12 !!", "xa"), (901, None, "xb"), (902, "the of ing", None)], "doc_id long, text string, lang string")
    model = string_kernel.fit(docs.filter("doc_id < 120 OR doc_id >= 900"))
    found = {r.doc_id: r for r in string_kernel.predict(docs, model).collect()}
    assert all(found[i].lang_pred == k for i, _, k in rows) and all(0 <= r.score <= 1 for r in found.values())
    assert found[900].lang_pred == found[901].lang_pred == "und" and found[902].lang_pred == "xa"


def test_language_without_anything_to_learn(odd, odd_rows):
    model = string_kernel.fit(odd.withColumn("lang", F.lit(None).cast("string")))
    found = string_kernel.predict(odd, model).collect()
    assert len(found) == len(odd_rows) and {r.lang_pred for r in found} == {"und"}


def test_grams_of_long_texts_are_not_cut(monkeypatch):
    text = prose(3, 500).encode()
    whole = string_kernel.grams(text)
    monkeypatch.setattr(string_kernel, "_SPAN", 64)
    assert (string_kernel.grams(text) == whole).all()


# decontamination


@pytest.fixture(scope="module")
def leaky(spark):
    items = [(i, prose(1000 + i, 14 + 2 * i)) for i in range(20)] + [(50, None), (51, ""), (52, items_short := "quite short")]
    docs, planted = [], set()
    for d in range(60):
        words = prose(d, 40 + 17 * d).split()
        for i in range(d % 3):
            item = (d * 7 + i * 5) % 20
            at = (d * 31) % len(words)
            words[at:at] = items[item][1].upper().split() if d % 2 else items[item][1].split()
            planted.add((d, item))
        docs.append((d, " ".join(words)))
    changed = items[10][1].split()
    changed[3], changed[9] = "other", "words"
    docs += [(80, prose(5, 100) + " " + " ".join(changed) + " " + prose(6, 100)), (81, f"a {items_short} text"), (82, None), (83, "")]
    schema = "doc_id long, text string"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(items, "item_id long, text string"), docs, items, planted


def test_leaks_are_those_of_a_plain_search(leaky):
    docs, items, rows, texts, planted = leaky
    got = {(r.doc_id, r.item_id) for r in lsa.leaks(docs, items).collect()}
    wanted = {(d, i) for d, t in rows for i, x in texts if plain.contains(t, x)}
    assert planted <= wanted and got == wanted | {(80, 10)}


def test_blocks_of_items_give_the_same(leaky, monkeypatch):
    docs, items, *_ = leaky
    whole = {(r.doc_id, r.item_id) for r in lsa.leaks(docs, items).collect()}
    monkeypatch.setattr(lsa, "ITEMS", 4)
    monkeypatch.setattr(lsa, "BLOCKS", 2)
    assert {(r.doc_id, r.item_id) for r in lsa.leaks(docs, items).collect()} == whole


def test_clean_documents_stay(leaky):
    docs, items, rows, texts, _ = leaky
    leaks = {d for d, t in rows for _, x in texts if plain.contains(t, x)} | {80}
    assert {r.doc_id for r in lsa.keep(docs, items).collect()} == {d for d, _ in rows} - leaks


def test_candidates_reach_the_recall_of_exact_cosines(leaky):
    """Of the pairs of window and passage that exact cosines bring up, at least 0.9 come up in the latent space."""
    docs, items, rows, texts, _ = leaky
    idf = lsa.inverse_frequencies(docs)
    (index,) = lsa.indexes(items, idf)
    weights = idf[lsa._slots(index.terms)]
    exact = found = 0
    for _, text in rows:
        hashes = lsa._words([(text or "").encode()])[0]
        for at in range(0, len(hashes), lsa.STRIDE):
            window = hashes[at : at + lsa.WINDOW]
            norm = np.sqrt((idf[lsa._slots(window)] ** 2).sum())
            inside = window[np.isin(window, index.terms)]
            columns, x, _ = lsa._vector(np.searchsorted(index.terms, inside), weights)
            latent = x @ index.vectors[columns] @ index.passages.T / norm
            for p, words in enumerate(lsa._words([t.encode()])[0] for _, t in texts if t):
                if not len(words):
                    continue
                c, y, n = lsa._vector(np.searchsorted(index.terms, words[: lsa.PASSAGE]), weights)
                both, a, b = np.intersect1d(columns, c, return_indices=True)
                if (x[a] * y[b]).sum() / norm / np.sqrt(n) >= lsa.COSINE:
                    exact += 1
                    found += latent.max() >= lsa.COSINE
    assert exact > 30 and found / exact >= 0.9


def _planted(spark, items, length):
    """A document for each item, with the item word by word in other text."""
    docs = []
    for i, text in items:
        words = prose(50_000 + i, length).split()
        words[17 + i % 40 : 17 + i % 40] = text.split()
        docs.append((i, " ".join(words)))
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), docs


def test_space_is_complete_for_many_items(spark):
    items = [(i, prose(90_000 + i, 20 + i % 40)) for i in range(512)]
    docs, rows = _planted(spark, items, 120)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    blocks = lsa.indexes(benchmark, lsa.inverse_frequencies(docs))
    assert all(len(b.passages) <= b.vectors.shape[1] for b in blocks) and sum(len(b.items) for b in blocks) == 512
    got = Counter((r.doc_id, r.item_id) for r in lsa.leaks(docs, benchmark).collect())
    assert got == Counter((d, i) for d, t in rows for i, x in items if plain.contains(t, x))


def test_an_item_of_many_passages_is_found_once(spark):
    items = [(1, prose(1, 700)), (2, prose(2, 30))]
    docs = spark.createDataFrame([(1, items[0][1]), (2, prose(3, 60) + " " + items[1][1])], "doc_id long, text string")
    found = lsa.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), rank=8)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 1), (2, 2)]


def test_short_items_are_found(spark):
    items = [(i, prose(70_000 + i, 1 + i % 23)) for i in range(230)]
    docs, rows = _planted(spark, items, 120)
    got = {(r.doc_id, r.item_id) for r in lsa.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    wanted = {(d, i) for d, t in rows for i, x in items if plain.contains(t, x)}
    assert {(i, i) for i, _ in items} <= wanted <= got


# mixing


def plain_targets(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        free -= set(over)
    return target


def test_mixture_meets_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 50)
    rows = [(i, prose(i, i % 23), ("big" if i % 3 else ("tiny", "é", None, "mid")[i // 3 % 4])) for i in range(900)] + [(7, "a b", "big")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(plain.words(text))
    wanted = plain_targets(sizes)
    assert len(got) == len(rows)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert {r.source_size for r in mine} == {size} and all(abs(r.target - wanted[source]) < 1e-6 for r in mine)
        assert abs(sum(r.size * r.copies for r in mine) - wanted[source]) < 0.06 * size + 25
        assert abs(sum(r.copies for r in mine) - len(mine) * wanted[source] / size) < 1.5
    assert max(r.copies for r in got) <= 2
    assert sorted(map(repr, got)) == sorted(map(repr, mixing.mix(docs.repartition(7)).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()))
    assert mixing.mixture(docs).count() == sum(r.copies for r in got)


def test_odd_rows_are_mixed(odd, odd_rows):
    found = mixing.mix(odd, source_column="value")
    assert found.count() == len(odd_rows) and found.filter("copies > 2 OR copies IS NULL").count() == 0


# empty tables


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a question about nothing at all")], "item_id long, text string")
    assert bottomk.near_duplicates(nothing).count() == 0 and bottomk.deduplicate(nothing).count() == 0
    assert rule_ledger.ledger(nothing).count() == 0 and rule_ledger.ablations(rule_ledger.ledger(nothing)).count() == 0
    assert factorisation.score(nothing, factorisation.fit(nothing, labels)).count() == 0
    assert string_kernel.predict(nothing, string_kernel.fit(nothing)).count() == 0
    assert lm_scoring.score(nothing, lm_scoring.train(nothing)).count() == 0
    assert lsa.leaks(nothing, items).count() == 0 and lsa.leaks(nothing, some).count() == 0 and lsa.keep(nothing, some).count() == 0
    assert mixing.mixture(nothing).count() == 0


def test_samples_stay_bounded_whatever_is_repeated(spark, monkeypatch):
    """One label for a thousand documents of one id, and null ids and copies in the sample of languages."""
    seen = {}
    for module in (factorisation, string_kernel):
        fitted = module._fit
        monkeypatch.setattr(module, "_fit", lambda found, *a, m=module, f=fitted: seen.__setitem__(m, len(found)) or f(found, *a))
    rows = [(1, prose(i, 30), "de", "s", i) for i in range(600)] + [(2, prose(5, 40), "de", "s", 1)] * 400
    rows += [(None, prose(2000 + i, 30), "fr", "s", 1) for i in range(500)] + [(3, prose(9, 40), "fr", "s", 1)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    factorisation.fit(docs, labels, sample=50)
    assert seen[factorisation] == 50
    string_kernel.fit(docs, key=F.col("doc_id"), sample=80)
    assert 20 <= seen[string_kernel] <= 160
