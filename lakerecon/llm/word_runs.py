"""Periodic runs of words, found in each text by a suffix automaton whose link tree is walked by link-cut access.

The automaton is built word by word. The preferred paths of a link-cut tree over its suffix links carry a colour: where the
words that their states stand for ended last. Appending a word accesses the state of the new prefix. Each segment of one
colour on the way to the root gives the longest suffix that ended there before: if it is at least as long as the way back to
that end, the two occurrences touch or overlap and make a square, whose period is that way; the accessed path is recoloured.
The square's stretch is known to its left end and is extended to its right end once per run.

Only stretches in which every window of some words occurs twice go into an automaton. Nothing is lost: in a run of at least
``least`` words and ``times`` periods each window of ``least * (times - 2) / times + 1`` words occurs again one period away.

Every row is one document and gives one row; rows with null or repeated ids too. Null and empty texts have no words and no
runs. Whole texts are taken, in one task each; memory follows the longest stretch of repeated words of one text. Other
columns of the input are not looked at.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import map_batches

#: The largest window by which stretches are chosen, in words.
WINDOW = 8

RUN = "struct<start: bigint, length: bigint, period: bigint>"


class SuffixAutomaton:
    """States, transitions and suffix links of a sequence; state 1 is the empty word, 0 is none."""

    def __init__(self, words: list[int]):
        self.length, self.link, self.prefix = [0, 0], [0, 0], []
        self.next: list[dict[int, int]] = [{}, {}]
        last = 1
        for word in words:
            last = self._append(last, word)
            self.prefix.append(last)

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _append(self, last: int, word: int) -> int:
        new = self._state(self.length[last] + 1, 1, {})
        at, following = last, self.next
        while at and word not in following[at]:
            following[at][word] = new
            at = self.link[at]
        if not at:
            return new
        old = following[at][word]
        if self.length[old] == self.length[at] + 1:
            self.link[new] = old
            return new
        copy = self._state(self.length[at] + 1, self.link[old], following[old].copy())
        self.link[old] = self.link[new] = copy
        while at and following[at].get(word) == old:
            following[at][word] = copy
            at = self.link[at]
        return new


class LastEnds:
    """A link-cut tree over a rooted forest, whose preferred paths are the segments of one colour.

    Preferred paths are splay trees ordered by depth; the colour of a path is kept at the root of its splay tree. Trees are
    never re-rooted, so nothing has to be turned around.
    """

    def __init__(self, parent: list[int]):
        self.parent, self.colour = list(parent), [0] * len(parent)
        self.above, self.below = [0] * len(parent), [0] * len(parent)

    def _rotate(self, x: int, y: int) -> None:
        parent, above, below = self.parent, self.above, self.below
        z = parent[y]
        if above[y] == x:
            moved = above[y] = below[x]
            below[x] = y
        else:
            moved = below[y] = above[x]
            above[x] = y
        if moved:
            parent[moved] = y
        if z:
            if above[z] == y:
                above[z] = x
            elif below[z] == y:
                below[z] = x
        parent[x], parent[y] = z, x

    def _splay(self, x: int) -> None:
        """``x`` becomes the root of its splay tree and takes the path's colour along."""
        parent, above, below = self.parent, self.above, self.below
        root = x
        while (y := parent[x]) and (above[y] == x or below[y] == x):
            z = parent[y]
            if z and (above[z] == y or below[z] == y):
                root = z
                if (above[z] == y) == (above[y] == x):
                    self._rotate(y, z)
                else:
                    self._rotate(x, y)
                    y = z
            else:
                root = y
            self._rotate(x, parent[x])
        self.colour[x] = self.colour[root]

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """(deepest state, colour) of the segments from ``state`` up to the root, all of which get the new colour."""
        found, lower, at = [], 0, state
        while at:
            self._splay(at)
            before = self.colour[at]
            if before:
                found.append((at, before))
            if self.below[at]:
                self.colour[self.below[at]] = before
            self.below[at] = lower
            lower, at = at, self.parent[at]
        self.colour[lower] = colour
        return found


def squares(words: list[int], least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` (two or more) periods."""
    automaton = SuffixAutomaton(words)
    ends, length = LastEnds(automaton.link), automaton.length
    found, reached = [], {}
    for i, state in enumerate(automaton.prefix, 1):
        for segment, before in ends.access(state, i):
            period, common = i - before, length[segment]
            if period > common or reached.get(period, 0) >= i:
                continue
            stop = i
            while stop < len(words) and words[stop] == words[stop - period]:
                stop += 1
            reached[period] = stop
            start = i - period - common
            if stop - start >= max(least, times * period):
                found.append((start, stop - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def window(least: int, times: int) -> int:
    """Words of the windows that must occur twice in a run; a power of two."""
    words = min(WINDOW, 1 + least * (times - 2) // times)
    return 1 << (words.bit_length() - 1)


def stretches(windows: np.ndarray, size: int, least: int) -> list[tuple[int, int]]:
    """(start, stop) of the longest stretches of at least ``least`` words in which every window occurs twice in the text."""
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    edges = np.diff(np.concatenate(([0], np.isin(windows, twice).view(np.int8), [0])))
    found = zip(np.flatnonzero(edges > 0).tolist(), (np.flatnonzero(edges < 0) + size - 1).tolist(), strict=True)
    return [(start, stop) for start, stop in found if stop - start >= least]


def _windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` words, by doubling; those at the end are joined with the start and must not be read."""
    step = 1
    while step < size:
        hashes = texts.mix(hashes * np.uint64(2 * step + 1) + np.roll(hashes, -step))
        step *= 2
    return hashes


def runs_of(words: list[bytes], windows: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """The runs of one text, by start and period. ``windows`` has a hash for each of its windows."""
    found = []
    for start, stop in stretches(windows, window(least, times), least):
        numbers: dict[bytes, int] = {}
        part = [numbers.setdefault(word, len(numbers)) for word in words[start:stop]]
        found += [(start + first, length, period) for first, length, period in squares(part, least, times)]
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that are not behind the first period of any run."""
    stays = np.ones(len(words), bool)
    for start, length, period in runs:
        stays[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def find(documents: DataFrame, least: int = 24, times: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: the id, ``n_words``, ``runs`` by start and period, ``strongest`` and ``collapsed``.

    A run is a longest stretch of words with one smallest period, of at least ``least`` words and ``times`` periods.
    ``strongest`` has the greatest length per period, then the smallest start, then the smallest period; null without
    runs. ``collapsed`` joins by a space the words that stay if each run keeps its first period only.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    size = window(least, times)
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    as_run = lambda run: run and dict(zip(("start", "length", "period"), run, strict=True))

    def out(batches):
        for batch in batches:
            at = 0
            for piece in texts.pieces(texts.column(batch, "text")):
                split = [(text or b"").split() for text in piece]
                hashes = _windows(texts.word_hashes([word for words in split for word in words]), size)
                numbers, all_runs, strongest, collapsed, first = [], [], [], [], 0
                for words in split:
                    runs = runs_of(words, hashes[first : first + max(len(words) - size + 1, 0)], least, times)
                    first += len(words)
                    numbers.append(len(words))
                    all_runs.append([as_run(run) for run in runs])
                    strongest.append(as_run(_strongest(runs)))
                    collapsed.append(b" ".join(collapse(words, runs) if runs else words))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(piece)),
                        pa.array(numbers, pa.int64()),
                        pa.array(all_runs, pa.list_(run_type)),
                        pa.array(strongest, run_type),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["id", "n_words", "runs", "strongest", "collapsed"],
                )
                at += len(piece)

    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            *T.StructType.fromDDL(f"n_words long, runs array<{RUN}>, strongest {RUN}, collapsed string").fields,
        ]
    )
    return map_batches(rows, out, schema).withColumnRenamed("id", id_column)
