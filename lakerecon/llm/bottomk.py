"""Near duplicates by bottom-k sketches from one hash function.

1. A document's set of word shingles is hashed once; the K smallest hashes are its sketch. Documents
   with equal sets form one class (a digest of the whole set), so copies never meet in pairs.
2. Inverted lists are kept by four retained values, as single ones are too frequent: each retained value is an anchor
   and is joined with the three smaller ones that a hash of the pair puts first. Below a value that two sketches retain
   both are complete, also where one text contains the other, so that the three others agree in 5 of 10 cases at
   similarity 0.8. Sets of up to WHOLE shingles are complete everywhere and join their anchors with any three others as well.
   README.md states the measured chance that no list is common. Sets of up to SMALL shingles use
   single values: all but the ceil(0.8 n) - 1 most frequent of the set, one of which similar sets must share.
   Lists with the same members are one list.
3. The most central class of a list is compared with all others, then the one nearest to it, which in a group of edited
   copies is the original. Union sketches estimate the similarity of such pairs and reject those under 2/5; the exact
   Jaccard similarity of the full sets decides. What is linked by then needs no comparison among itself, and a list of
   one component is done.
4. Classes of the lists that are left are compared in blocks by their sketches as matrix products, those of one component
   not with each other. Full sets move only for classes that have 2/5 of their sketch in common with one of another
   component: such classes are compared, again in blocks, by their full sets. A block gives a
   forest of links, so no group is expanded into its pairs. No list is cut: sets that share one are
   compared, or are in one component already.
5. Components are found by alternating star contraction on the links.

Null or empty texts, and texts without words, have an empty set and are linked with nothing. A
document with fewer words than a shingle has the whole sequence as its only shingle. Rows with a null id are
kept and linked with nothing. Repeated rows are copies like any others. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerecon.llm import texts
from lakerecon.llm.frames import cut, map_batches, map_groups, small

#: Retained values, shingles up to which anchors look for others on both sides, and up to which sets use single values.
K = 64
WHOLE = 40
SMALL = 20
#: Sketches of a piece, and shingles of a piece of full sets, of which a small one counts as LEAST; a block has two pieces at most.
SKETCHES = 1_024
BLOCK = 800_000
LEAST = 400
#: Shingles in at most so many sets of a block are counted pair by pair, others by matrix products.
FEW = 12
#: Cells of such a matrix, and rows of what is as large as all pairs that are worked off at a time.
MATRIX = 1 << 22
ROWS = 256


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray | None]:
    for piece in texts.pieces(texts.column(batch, "text")):
        hashes, bounds = texts.tokens(piece)
        grams, at = texts.ngrams(hashes, bounds, width)
        grams = grams >> np.uint64(1)
        for i in range(len(piece)):
            if at[i + 1] > at[i]:
                yield np.unique(grams[at[i] : at[i + 1]])
            elif bounds[i + 1] > bounds[i]:
                yield texts.sequence_hash(hashes[bounds[i] : bounds[i + 1]]) >> np.uint64(1)
            else:
                yield None


def _digest(values: np.ndarray) -> bytes:
    return blake2b(values.tobytes(), digest_size=16).digest()


def _keys(values: np.ndarray) -> np.ndarray:
    """Hashes of each retained value (ascending) and the three smaller ones that go with it; of few, any three as well."""
    if len(values) <= SMALL:
        return values[:0]
    pairs = texts.mix(values[:, None] * np.uint64(0x9E3779B97F4A7C15) ^ values[None, :])
    mixed, none = texts.mix(values), np.uint64(2**64 - 1)
    place = np.arange(len(values))

    def joined(order: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        three = mixed[np.argpartition(order, 2, axis=1)[:, :3]]
        return texts.mix(anchors * np.uint64(0xC2B2AE3D27D4EB4F) + three.sum(1, dtype=np.uint64)) >> np.uint64(1)

    found = joined(np.where(place[None, :] < place[:, None], pairs, none)[3:], values[3:])
    if len(values) <= WHOLE:
        found = np.concatenate([found, joined(np.where(place[None, :] == place[:, None], none, pairs), values)])
    return np.unique(found)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, found)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)))


def described(documents: DataFrame, id_column: str, text_column: str, width: int, k: int = K) -> DataFrame:
    """id, n_shingles, node (digest of the set, null if empty), sketch, and singles (of inverted lists) of every document."""
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    none = np.empty(0, np.uint64)

    def run(batches):
        for batch in batches:
            sizes, nodes, sketches, singles = [], [], [], []
            for values in _sets(batch, width):
                size = 0 if values is None else len(values)
                sizes.append(size)
                nodes.append(_digest(values) if size else None)
                sketches.append(values[:k] if size else none)
                singles.append(values if 0 < size <= SMALL * 5 // 4 else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), _lists(sketches), _lists(singles)],
                names=["id", "n_shingles", "node", "sketch", "singles"],
            )

    schema = T.StructType(
        [
            T.StructField("id", rows.schema["id"].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.BinaryType()),
            T.StructField("sketch", T.ArrayType(T.LongType())),
            T.StructField("singles", T.ArrayType(T.LongType())),
        ]
    )
    return map_batches(rows, run, schema)


def _full_sets(rows: DataFrame, width: int) -> DataFrame:
    """(node, values): all hashes of each document's set, ascending."""

    def run(batches):
        for batch in batches:
            found = [x for x in _sets(batch, width) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_digest(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())], names=["node", "values"]
            )

    return map_batches(rows, run, "node binary, values binary")


def _compared(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, similarity, linked) of pairs with their full sets; linked: 100 * intersection >= percent * union."""

    def run(batches):
        for batch in batches:
            similarity, linked = [], []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, other))
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                similarity.append(common / union)
                linked.append(100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(similarity, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "similarity", "linked"]
            )

    return map_batches(pairs, run, "a binary, b binary, similarity double, linked boolean")


def _keyed(classes: DataFrame) -> DataFrame:
    """(value, node, n): the keys of each class."""

    def run(batches):
        for batch in batches:
            sketches = batch.column(2)
            values, ends = sketches.values.to_numpy().view(np.uint64), sketches.offsets.to_numpy()
            keys = [_keys(values[lo:hi]) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            of = pa.array(np.repeat(np.arange(len(keys)), [len(x) for x in keys]))
            flat = np.concatenate([np.empty(0, np.uint64), *keys]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), batch.column(0).take(of), batch.column(1).take(of)], names=["value", "node", "n"])

    return map_batches(classes.select("node", "n", "sketch"), run, "value long, node binary, n long")


def postings(classes: DataFrame) -> DataFrame:
    """(value, node, n, weight): the inverted lists of two or more classes, each set of members once.

    ``weight`` is the length of all lists of a class.
    """
    every = _keyed(classes).withColumn("single", F.lit(False)).union(classes.select(F.explode("singles").alias("value"), "node", "n", F.lit(True)))
    common = cut(every.groupBy("value").count().filter("count > 1"), "bottomk-values")
    mine = cut(every.join(small(common), "value"), "bottomk-common")
    needed = F.ceil(F.col("n") * 0.8).cast("int")
    few = mine.filter("single").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("count", "value"))).alias("v")).filter(F.size("v") >= needed)
    few = few.select("node", "n", F.explode(F.slice("v", F.lit(1), F.size("v") - needed + 1)).alias("v")).select("v.value", "node", "n")
    lists = mine.filter("NOT single").select("value", "node", "n").union(few)
    members = [F.count("*").alias("count"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")]
    once = lists.groupBy("value").agg(*members).filter("count > 1").groupBy("count", "x", "y").agg(F.min("value").alias("value"))
    lists = cut(lists.join(small(cut(once.select("value", "count"), "bottomk-once")), "value"), "bottomk-lists")
    return lists.join(lists.groupBy("node").agg(F.sum("count").alias("weight")), "node").select("value", "node", "n", "weight")


def stars(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node of its component and is not listed itself."""
    edges, before = links.select("a", "b").filter("a <> b"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        near = large.join(least, "a")
        edges = cut(
            near.filter("b <> m").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).union(least.select("a", "m")).distinct(), "stars"
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Roots with more links taken in."""
    if links.isEmpty():
        return roots
    return stars(links if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def _pairs(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Pivots with the members of their lists in other components whose sizes allow the similarity."""
    met = members.join(pivots, "value").filter("comp <> p_comp")
    met = met.filter(100 * F.least("n", "p_n") >= percent * F.greatest("n", "p_n"))
    met = met.select(F.col("p_node").alias("a"), F.col("node").alias("b"))
    return met.groupBy(F.least("a", "b"), F.greatest("a", "b")).agg(F.min(F.struct("a", "b")).alias("pair")).select("pair.*")


def _pivots(members: DataFrame, step: int) -> DataFrame:
    """The member of each list that is compared with the others in this round."""
    rank = F.struct("weight", "node") if step == 0 else F.struct("near", "weight", "node")
    return members.groupBy("value").agg(F.max_by(F.struct("node", "n", "comp"), rank).alias("p")).select("value", "p.*")


def _nearness(members: DataFrame, pivots: DataFrame, compared: DataFrame) -> DataFrame:
    """``near``: the similarity with the pivot of the list, 0 if it was not worth comparing."""
    both = compared.select(F.col("a").alias("p_node"), F.col("b").alias("node"), "similarity").union(compared.select("b", "a", "similarity"))
    met = members.join(pivots.select("value", "p_node"), "value", "left").join(both, ["p_node", "node"], "left")
    return met.select("value", "node", "n", "weight", F.coalesce("similarity", "near").alias("near"))


def _alike(pairs: DataFrame, sketches: DataFrame, k: int) -> DataFrame:
    """Without the pairs whose union sketch has less than 2/5 of its values in common."""
    one = sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    other = sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    both = pairs.join(one, "a").join(other, "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    common = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    return both.filter(5 * common >= 2 * F.size(union)).select("a", "b")


def _components(postings: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Postings with their present component, without the lists that are of one component."""
    members = postings.withColumn("comp", F.col("node")) if roots is None else (
        postings.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    )
    lists = members.groupBy("value").agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return members.join(lists.select("value", "size"), "value")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets; those with themselves may be too low."""
    elements = np.concatenate(sets)
    order = np.argsort(elements, kind="stable")
    elements = elements[order]
    # The owners of one element stand together.
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])[order]
    del order
    starts = np.flatnonzero(np.concatenate(([True], elements[1:] != elements[:-1])))
    seen = np.diff(starts, append=len(elements))
    del elements
    common = np.zeros((len(sets), len(sets)), np.float32)
    for times in range(2, FEW + 1):
        rows = owner[starts[seen == times][:, None] + np.arange(times)]
        for i in range(times):
            for j in range(i + 1, times):
                np.add.at(common, (rows[:, i], rows[:, j]), 1)
    for low in range(0, len(sets), ROWS):
        part = common[low : low + ROWS, low:]
        part += common[low:, low : low + ROWS].T.copy()
        common[low:, low : low + ROWS] = part.T
    usual = np.flatnonzero(seen > FEW)
    step = max(1, MATRIX // len(sets))
    for low in range(0, len(usual), step):
        first, times = starts[usual[low : low + step]], seen[usual[low : low + step]]
        column = np.repeat(np.arange(len(first)), times)
        at = np.arange(len(column)) + np.repeat(first - (np.cumsum(times) - times), times)
        matrix = np.zeros((len(sets), len(first)), np.float32)
        matrix[owner[at], column] = 1
        for row in range(0, len(sets), ROWS):
            common[row : row + ROWS] += matrix[row : row + ROWS] @ matrix.T
    return common


def _trees(linked: np.ndarray) -> list[tuple[int, int]]:
    """Each position that is not the first of its component, with the first."""
    np.fill_diagonal(linked, True)
    labels, before = np.arange(len(linked), dtype=np.int32), None
    while before is None or (labels != before).any():
        before = labels
        labels = np.concatenate(
            [np.where(linked[low : low + ROWS], before[None, :], np.int32(len(linked))).min(1) for low in range(0, len(linked), ROWS)]
        )
    return [(i, int(x)) for i, x in enumerate(labels) if i != x]


def _alike_sketches(sketches: list[np.ndarray]) -> np.ndarray:
    """Which sketches have 2/5 of the longer one in common."""
    kept, common = np.array([len(x) for x in sketches], np.float32), _overlaps(sketches)
    alike = np.empty(common.shape, bool)
    for low in range(0, len(kept), ROWS):
        alike[low : low + ROWS] = 5 * common[low : low + ROWS] >= 2 * np.maximum(kept[low : low + ROWS, None], kept[None, :])
    return alike


def _forest(sets: list[np.ndarray], percent: int, k: int = K) -> list[tuple[int, int]]:
    """Links (positions) that connect what all links between similar sets would connect."""
    maybe = _alike_sketches([x[:k] for x in sets])
    np.fill_diagonal(maybe, False)
    some = np.flatnonzero(maybe.any(1))
    if not len(some):
        return []
    sizes = np.array([len(sets[i]) for i in some])
    common = _overlaps([sets[i] for i in some])
    linked = np.empty(common.shape, bool)
    for low in range(0, len(some), ROWS):
        mine = common[low : low + ROWS].astype(np.int64)
        linked[low : low + ROWS] = 100 * mine >= percent * (sizes[low : low + ROWS, None] + sizes[None, :] - mine)
    del common
    return [(int(some[i]), int(some[x])) for i, x in _trees(linked)]


def _sketch_forest(sketches: list[np.ndarray], components: list[bytes]) -> list[tuple[int, int]]:
    """Positions connected as by all alike sketches of different components."""
    comp = np.unique(np.array(components, object), return_inverse=True)[1]
    return _trees(_alike_sketches(sketches) & (comp[:, None] != comp[None, :])) if comp.max() else []


def _in_blocks(members: DataFrame, sets: DataFrame, size, limit: int, forest) -> DataFrame:
    """Links (a, b) that ``forest`` finds between the classes that share a list; ``members``: value, node, n.

    Classes that lists connect are a family. A family is cut into pieces of about ``limit`` by ``size``, and of two pieces those
    classes meet whose lists reach into the other; small families share a block. A task gives the ``values`` and ``comp`` of
    ``sets`` in a family of its block to ``forest``.
    """
    near = members.groupBy("value").agg(F.min("node").alias("first"))
    edges = members.join(near, "value").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    nodes = members.select("node", "n").distinct()
    families = nodes.join(stars(cut(edges, "bottomk-edges")), "node", "left").select("node", "n", F.coalesce("root", "node").alias("family"))
    sums = families.groupBy("family").agg(F.sum(size).alias("all"))
    blocks = F.greatest(F.lit(1), F.ceil(F.lit(nodes.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] / limit)))
    placed = cut(
        families.join(sums, "family").select(
            "node", "family", F.pmod(F.xxhash64("family"), blocks).alias("bin"), F.pmod(F.xxhash64("node"), F.ceil(F.col("all") / limit)).alias("piece")
        ),
        "bottomk-families",
    )
    at = members.select("value", "node").join(placed, "node")
    # The lists of a family reach into few sets of pieces, so a class has few such sets however many lists it is in.
    reach = at.groupBy("value").agg(F.array_sort(F.collect_set("piece")).alias("reach"))
    at = at.join(reach, "value").select("family", "bin", "piece", "node", "reach").distinct()
    at = at.groupBy("family", "bin", "piece", "node").agg(F.array_distinct(F.flatten(F.collect_list("reach"))).alias("reach"))
    sides = at.withColumn("with", F.explode("reach")).select("family", "bin", F.least("piece", "with").alias("i"), F.greatest("piece", "with").alias("j"), "node")
    held = sides.join(sets.select("node", "comp", "values"), "node")
    whole = F.when((F.col("i") == 0) & (F.col("j") == 0), F.lit(None)).otherwise(F.col("family"))
    keyed = held.select(F.struct("bin", "i", "j", whole.alias("own")).alias("block"), "family", "node", "comp", "values")

    def run(table: pa.Table) -> pa.Table:
        one, two = [], []
        by: dict[bytes, list[int]] = {}
        for i, family in enumerate(table.column("family").to_pylist()):
            by.setdefault(family, []).append(i)
        node, comp, values = (table.column(c).to_pylist() for c in ("node", "comp", "values"))
        for rows in by.values():
            for x, y in forest([np.frombuffer(values[i], np.uint64) for i in rows], [comp[i] for i in rows]):
                one.append(node[rows[x]])
                two.append(node[rows[y]])
        return pa.table({"a": pa.array(one, pa.binary()), "b": pa.array(two, pa.binary())})

    return map_groups(keyed, "block", run, "a binary, b binary")


def _binary(sketches: DataFrame) -> DataFrame:
    """(node, values) with the sketch as bytes."""

    def run(batches):
        for batch in batches:
            values, ends = batch.column(1).values.to_numpy(), batch.column(1).offsets.to_numpy()
            packed = [values[lo:hi].tobytes() for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["node", "values"])

    return map_batches(sketches.select("node", "sketch"), run, "node binary, values binary")


def _linked_in_blocks(members: DataFrame, sketches: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of different components that share a list: first by sketches, then by the full sets of those alike.

    Classes that alike sketches connect are a list of the second step, in which all of them are compared.
    """
    comps = members.select("node", "comp").distinct()
    alike = cut(_in_blocks(members, _binary(sketches).join(comps, "node"), F.lit(1), SKETCHES, _sketch_forest), "bottomk-alike")
    groups = stars(alike)
    groups = cut(groups.select(F.col("root").alias("value"), "node").union(groups.select("root", "root")).distinct(), "bottomk-groups")
    again = groups.join(members.select("node", "n").distinct(), "node")
    return _in_blocks(
        again, full.withColumn("comp", F.col("node")), F.greatest("n", F.lit(LEAST)), BLOCK, lambda sets, _: _forest(sets, percent)
    )


def _found(documents: DataFrame, id_column: str, text_column: str, width: int, percent: int, k: int) -> DataFrame:
    """id, n_shingles, node, root (node that stands for the component) and least (smallest id of it) of every document."""
    if percent < 80:
        raise ValueError("sketches find links from 80 per cent on")
    rows = cut(described(documents, id_column, text_column, width, k), "bottomk-described")
    classes = cut(
        rows.filter("node IS NOT NULL AND id IS NOT NULL")
        .groupBy("node")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("singles").alias("singles")),
        "bottomk-classes",
    )
    left = cut(postings(classes).withColumn("near", F.lit(0.0)), "bottomk-postings")
    nodes = cut(left.select("node").distinct(), "bottomk-nodes")
    wanted = cut(classes.select("node", "rep").join(small(nodes), "node").select(F.col("rep").alias("id")).distinct(), "bottomk-wanted")
    sources = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    sketches = cut(classes.select("node", "sketch").join(small(nodes), "node", "left_semi"), "bottomk-sketches")
    full = _full_sets(sources.join(small(wanted), "id", "left_semi"), width)
    full = cut(full.join(small(nodes), "node", "left_semi").dropDuplicates(["node"]), "bottomk-sets")
    roots = None
    for step in range(2):
        members = cut(_components(left, roots), "bottomk-members")
        if members.isEmpty():
            break
        pivots = cut(_pivots(members, step).select("value", F.col("node").alias("p_node"), F.col("n").alias("p_n"), F.col("comp").alias("p_comp")), "bottomk-pivots")
        pairs = cut(_alike(_pairs(members, pivots, percent), sketches, k), "bottomk-pairs")
        filled = pairs.join(full.select(F.col("node").alias("b"), F.col("values").alias("vb")), "b").join(
            full.select(F.col("node").alias("a"), F.col("values").alias("va")), "a"
        )
        compared = cut(_compared(filled.select("a", "b", "va", "vb"), percent), "bottomk-compared")
        roots = _joined(roots, compared.filter("linked").select("a", "b"))
        left = members.join(pivots.select("value", F.col("p_node").alias("node")), ["value", "node"], "left_anti").select("value", "node", "n", "weight", "near")
        left = cut(_nearness(left, pivots, compared) if step == 0 else left, "bottomk-left")
    rest = cut(_components(left, roots), "bottomk-rest")
    if not rest.isEmpty():
        roots = _joined(roots, cut(_linked_in_blocks(rest, sketches, full, percent), "bottomk-links"))
    named = classes.select("node", "rep", F.col("node").alias("root"))
    if roots is not None:
        named = named.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        smallest = named.groupBy("root").agg(F.min("rep").alias("least"))
        named = named.join(smallest, "root").select("node", "root", F.col("least").alias("rep"))
    return rows.join(named, "node", "left").select(
        "id", "n_shingles", "node", "root", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("least")
    )


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80, k: int = K
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable by links, itself included).

    Documents are linked if 100 * intersection >= percent * union of their sets of ``width``-word shingles;
    ``percent`` is 80 or more.
    """
    found = _found(documents, id_column, text_column, width, percent, k)
    return found.select(F.col("id").alias(id_column), "n_shingles", F.col("least").alias("component_id"))


def _with_node(rows: DataFrame, text_column: str, width: int, name: str) -> DataFrame:
    """The rows with the digest of their set, null if it is empty."""
    at = rows.columns.index(text_column)

    def run(batches):
        for batch in batches:
            text = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
            nodes = [None if x is None else _digest(x) for x in _sets(text, width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=[*batch.schema.names, name])

    return map_batches(rows, run, T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())]))


def deduplicate(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that are not the smallest id of their component.

    Rows of a repeated id are judged each by its own text: of each component of which the id is the smallest one row stays, and
    of rows without words one for each text. Rows with a null id all stay. The columns are those of the input.
    """
    found = cut(_found(documents, id_column, text_column, width, percent, K), "bottomk-components")
    found = found.filter("id IS NOT NULL")
    twice = cut(found.groupBy("id").count().filter("count > 1").select(F.col("id").alias(id_column)), "bottomk-repeated")
    go = found.filter("id <> least").select(F.col("id").alias(id_column)).distinct()
    names = documents.columns
    if twice.isEmpty():
        return documents.join(small(go), id_column, "left_anti").select(*names)
    once = documents.join(small(twice), id_column, "left_anti").join(small(go), id_column, "left_anti").select(*names)
    node = "bottomk_node"
    while node in names:
        node += "_"
    first = found.filter("id = least AND node IS NOT NULL").groupBy("root").agg(F.min(F.struct("id", "node")).alias("x"))
    first = first.select(F.col("x.id").alias(id_column), F.col("x.node").alias(node))
    again = _with_node(documents.join(small(twice), id_column, "left_semi").select(*names), text_column, width, node)
    some = again.filter(F.col(node).isNotNull()).join(small(first.join(small(twice), id_column, "left_semi")), [id_column, node], "left_semi")
    some = some.select(*names, node).dropDuplicates([id_column, node])
    none = again.filter(F.col(node).isNull()).dropDuplicates([id_column, text_column])
    return once.unionByName(some.select(*names)).unionByName(none.select(*names))
