"""Line removal, periodic runs and the trie of conversations, against plain versions and on odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import plain
import pytest
from plain import prose

from lakerecon.llm import line_dedup, prefix_trie, radix, texts, word_runs

CLASH = "id long, text string, n_lines int, n_dropped string, row int, runs int, places int, digest string, _c0 int, kept int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, "d", 5, 6) for i, t in rows], CLASH).repartition(5)


# runs


def test_runs_are_those_of_all_periods():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randrange(0, 80)
        words = [rng.randrange(rng.choice((1, 2, 3))) for _ in range(n)]
        if n and rng.random() < 0.6:
            start, period = rng.randrange(n), rng.randrange(1, 9)
            words = [words[i] if i < start else words[(start + (i - start) % period) % n] for i in range(n)]
        for least, times in ((1, 2), (6, 3), (24, 3), (8, 4)):
            assert word_runs.squares(words, least, times) == plain.runs(words, least, times)
            split, size = [b"%d" % w for w in words], word_runs.window(least, times)
            windows = word_runs._windows(texts.word_hashes(split), size)[: max(n - size + 1, 0)]
            assert word_runs.runs_of(split, windows, least, times) == plain.runs(split, least, times)


def test_access_recolours_paths():
    parent = [0, 0, 1, 2, 3, 2, 5]
    tree, colour = word_runs.LastEnds(parent), [0] * 7
    rng = random.Random(5)
    for step in range(1, 200):
        at = node = rng.randrange(1, 7)
        wanted = []
        while node:
            if colour[node] and (not wanted or wanted[-1][1] != colour[node]):
                wanted.append((node, colour[node]))
            colour[node] = step
            node = parent[node]
        assert tree.access(at, step) == wanted


def test_many_and_long_runs_take_no_longer():
    fibonacci, following = [0], [0, 1]
    while len(following) < 6000:
        fibonacci, following = following, following + fibonacci
    assert len(word_runs.squares(following[:6000], 2, 2)) > 3000
    assert word_runs.squares([7] * 6000, 24, 3) == [(0, 6000, 1)]


def test_runs_of_odd_rows(spark):
    base = prose(11, 40)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (None, base + " x " + "a b c " * 12), (None, None), (5, "a " * 23), (6, "a " * 24), (7, "A a " * 12)]
    rows += [(8, " ".join([base] * 4)), (8, " ".join([base] * 4)), (9, " ".join([base] * 2)), (10, prose(4, 3000) + " " + "é ß " * 5000 + prose(5, 3000))]
    rows += [(11, "a b " * 12 + "a a " + "a b " * 20), (12, ("a " * 30 + "b ") * 3)]
    got = Counter()
    for r in word_runs.find(clashing(spark, rows), id_column="id").collect():
        best = r.strongest and tuple(r.strongest)
        got[(r.id, r.n_words, tuple(tuple(x) for x in r.runs), best, r.collapsed)] += 1
    wanted = Counter()
    for key, text in rows:
        words = plain.words(text)
        if len(words) > 8000:
            runs = [(3000, 10_000, 2)]
        else:
            runs = plain.runs(words)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        wanted[(key, len(words), tuple(runs), best, b" ".join(plain.collapsed(words, runs)).decode())] += 1
    assert got == wanted and sum(len(k[2]) > 0 for k in got) >= 6


def test_runs_of_an_empty_table(spark):
    assert word_runs.find(spark.createDataFrame([], "doc_id string, text string")).collect() == []
    with pytest.raises(ValueError):
        word_runs.find(spark.createDataFrame([], "doc_id string, text string"), times=1)


# lines


def lines(n=60):
    rng = random.Random(9)
    common = [f"shared line {'abc' * k}" for k in range(12)]
    rows = []
    for i in range(n):
        own = [prose(1000 + 7 * i + k, 5) for k in range(rng.randrange(4))]
        shared = [rng.choice((" ", "", "\t")) + rng.choice((str.upper, str))(c) + rng.choice((" ", "", "\r")) for c in common if rng.random() < 0.2]
        shared += ["é ß"] * (i % 5 == 0) + ["É ß"] * (i % 6 == 0)
        text = own + shared + [""] * rng.randrange(2) + shared[:1]
        rng.shuffle(text)
        rows.append((i, "\n".join(text)))
    return rows + [(60, None), (61, ""), (None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1]), (62, "\n\n"), (63, "  \n" + rows[2][1]), (64, "x" * 200_000), (65, "é")]


@pytest.mark.parametrize("sent", [1 << 18, 3, 1])
@pytest.mark.parametrize("least", [(10, 1), (2, 1), (3, 0), (2, 30)])
def test_shared_lines_go_however_their_hashes_travel(spark, monkeypatch, sent, least):
    monkeypatch.setattr(line_dedup, "SENT", sent)
    rows = lines()
    wanted = Counter((i, *found) for (i, _), found in zip(rows, plain.without_shared_lines([t for _, t in rows], *least)))
    kept = line_dedup.drop(clashing(spark, rows), *least)
    assert kept.columns == [*(c.split()[0] for c in CLASH.split(", ")), "_n_lines", "_n_dropped"]
    assert Counter((r.id, r._n_lines, r._n_dropped, r.text) for r in kept.collect()) == wanted
    assert {(r.n_lines, r.n_dropped, r.row, r.kept) for r in kept.collect()} == {(1, "x", 2, 6)}
    if least == (2, 1):
        assert sum(w[2] for w in wanted) > 50


def test_lines_of_an_empty_table(spark):
    assert line_dedup.drop(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = line_dedup.drop(spark.createDataFrame([("a\nb",)] * 10 + [("c",)], "text string"))
    assert Counter(map(tuple, only.collect())) == Counter({("", 2, 2): 10, ("c", 1, 0): 1})


# tries


def test_radix_tree_holds_what_a_dict_holds():
    rng = random.Random(2)
    tree, wanted = radix.Tree(), {}
    for row in range(4000):
        key = bytes(rng.randrange(rng.choice((2, 20, 60, 256))) for _ in range(2 * rng.randrange(4)))
        tree.insert(key, row)
        wanted.setdefault(key, []).append(row)
    below, kinds = {}, Counter()
    for node, above, end in tree.postorder():
        kinds[type(node.children).__name__] += 1
        found = [(b"", node.rows)] if node.rows else []
        for byte, child in node.children.items():
            assert node.children.get(byte) is child
            found += [(bytes([byte]) + key, rows) for key, rows in below.pop(id(child))]
        assert node is tree.root or len(found) > 1 or node.rows
        below[id(node)] = [(node.path + key, rows) for key, rows in found]
        assert end - above == len(node.path) + (node is not tree.root)
    assert dict(below[id(tree.root)]) == wanted and [k for k, _ in below[id(tree.root)]] == sorted(wanted)
    assert set(kinds) == {"Sorted", "Indexed", "Direct"}


def conversations():
    rng = random.Random(4)
    shared = [("user", "hello there"), ("assistant", "hi you two"), (None, "three little words"), ("user", None)]
    made = {}
    for c in range(80):
        made[c] = shared[: rng.randrange(5)] + [("user", prose(rng.randrange(3), 4)) for _ in range(rng.randrange(3))]
    made |= {200 + c: shared + [("user", "the same")] for c in range(40)}
    made |= {300 + c: [("user", str(k % (7 + c % 2))) for k in range(30 + c)] for c in range(5)}
    return {c: [(r or "", t or "") for r, t in turns] for c, turns in made.items()}


@pytest.mark.parametrize(("band", "tree"), [(128, 1 << 18), (128, 20), (2, 1 << 18), (4, 9), (1, 1)])
def test_trie_is_that_of_all_prefixes(spark, band, tree):
    made = conversations()
    rows = [(c, k if k else None, r, t, 1, "x") for c, turns in made.items() for k, (r, t) in enumerate(turns)]
    rows += [(None, 0, "user", "nobody's", 1, "x")]
    random.Random(1).shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int, id string").repartition(5)
    turns = prefix_trie.digest(table)
    none = spark.createDataFrame([(c, None, None, None) for c in made], "conv_id long, turn long, id binary, tokens long")
    got = prefix_trie.trie(turns.unionByName(none), band, tree).collect()
    wanted = {k: (*v[:5], hashlib.sha256(v[5].encode()).hexdigest()) for k, v in plain.trie(made).items()}
    assert len(got) == len(wanted)
    assert {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got} == wanted


def test_repeated_turns_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.conversations_trie(spark.createDataFrame([], schema)).collect() == []
    assert prefix_trie.conversations_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).collect() == []
    twice = spark.createDataFrame([(-5, 0, None, None)] * 2 + [(7, 0, "", "")], schema)
    got = {(r.conv_id, r.depth): (r.n_convs, r.n_leaves, r.saved_tokens) for r in prefix_trie.conversations_trie(twice).collect()}
    assert got == {(-5, 0): (2, 1, 0), (-5, 1): (2, 1, 0), (-5, 2): (1, 1, 0)}


def test_places_do_not_depend_on_partitions(spark):
    rows = [(c, t, f"{c} {t}") for c in range(6) for t in range(3 if c != 4 else 400)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, text string").selectExpr("conv_id", "turn", "cast(text as binary) id", "1L tokens")
    got = prefix_trie.numbered(turns.repartition(7)).collect()
    assert len(got) == len(rows) and all(r.place == int(bytes(r.id).split()[1]) for r in got)
    assert np.bincount([r.conv_id for r in got]).tolist() == [3, 3, 3, 3, 400, 3]
