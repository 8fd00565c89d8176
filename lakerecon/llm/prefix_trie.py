"""The trie of all conversations by their first turns, out of adaptive radix trees.

A turn is known by a fixed-width, big-endian id of 16 bytes, the MD5 of role and text, so no table of turns is needed; a
conversation is the string of its ids. Radix trees branch at any byte, but only depths at the end of a turn are nodes here.

Strings are dealt out by ranges in their order, equal ones by conversation, and each task builds its trees over a bounded
number of turns at a time. All strings below a node stand together in that order. So only the nodes on the first and the
last string of a tree can have members elsewhere: these are merged by the hash of their prefix, and what lies below them
is added up along ancestors 1, 2, 4 ... levels above. All other nodes are finished where they are. Strings of more than
BAND turns are cut into bands, each a string below the prefix before it; nodes on the way to a further band are merged too.
A node that many conversations share, or one conversation with most turns, is therefore spread over tasks. Only the digest
of a node's ends is one sequential job for each node, over texts of many ids each.

Turns with equal numbers come in the order of their ids; null numbers come first. Null roles and texts are empty. A
repeated row is a further turn. Rows without a conversation id belong to no conversation and are not looked at; ids are
whole numbers. A table without conversations has no node, not even a root. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerecon.llm.frames import cut, map_batches, small
from lakerecon.llm.radix import Tree

#: Bytes of a turn's id.
WIDTH = 16
#: Turns of a string, and turns (or strings without any) of a tree.
BAND = 128
TREE = 1 << 18

PREFIX = ["depth", "high", "low"]
NODE = (
    "merge boolean, depth long, high long, low long, parent_high long, parent_low long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, tokens long, first_end long, ends string"
)


def digest(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``id`` and ``tokens`` (words of the text) of every turn that has a conversation."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    known = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    found = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", known.alias("id"), words.alias("tokens"))
    return found.filter("conv_id IS NOT NULL")


def numbered(turns: DataFrame) -> DataFrame:
    """``place``, from 0, of every turn in its conversation, without one task for one conversation.

    The turns are sorted in ranges; a conversation that goes on in another range is counted on from there, and in each
    range at most one does.
    """
    order = ["conv_id", "turn", "id"]
    ranged = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row")
    kept = cut(ranged.withColumn("range", F.spark_partition_id()), "numbered-turns")
    counts = kept.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    on = counts.withColumn("before", F.sum("n").over(before)).filter("before IS NOT NULL").select("conv_id", "range", "before")
    here = Window.partitionBy("conv_id", "range").orderBy("turn", "id", "row")
    placed = kept.withColumn("place", F.row_number().over(here).cast("long") - 1)
    placed = placed.join(F.broadcast(on), ["conv_id", "range"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "id", "tokens")


def _strings(turns: DataFrame, band: int) -> DataFrame:
    """One row per conversation and band: the ids in a row, with what each turn adds to the hash of a prefix."""
    turn = F.struct("place", "id", "tokens", *(F.xxhash64(F.lit(seed), "place", "id").alias(name) for seed, name in enumerate(("high", "low"))))
    real = numbered(turns.filter("id IS NOT NULL")).select("conv_id", F.floor(F.col("place") / band).alias("band"), turn.alias("t"))
    none = turns.filter("id IS NULL").select("conv_id", F.lit(0).cast("long").alias("band"), F.lit(None).cast(real.schema["t"].dataType).alias("t")).distinct()
    banded = real.unionByName(none).groupBy("conv_id", "band").agg(
        F.sort_array(F.collect_list("t")).alias("t"), *(F.coalesce(F.bit_xor(f"t.{name}"), F.lit(0).cast("long")).alias(f"all_{name}") for name in ("high", "low"))
    )
    key = F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["id"])), ""))
    banded = banded.withColumn("key", key).select(
        "conv_id", "band", "key", "all_high", "all_low", *(F.col(f"t.{name}").alias(name) for name in ("tokens", "high", "low"))
    )
    kept = cut(banded, "strings")
    order = Window.partitionBy("conv_id").orderBy("band")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    long = kept.select(
        "conv_id", "band", *(F.bit_xor(f"all_{name}").over(before).alias(f"start_{name}") for name in ("high", "low")),
        F.lead("band").over(order).isNotNull().alias("continues"),
    ).filter("band > 0 OR continues")
    zero = F.lit(0).cast("long")
    return kept.join(long, ["conv_id", "band"], "left").select(
        "conv_id", "band", "key", "tokens", "high", "low",
        *(F.coalesce(f"start_{name}", zero).alias(f"start_{name}") for name in ("high", "low")),
        F.coalesce("continues", F.lit(False)).alias("continues"),
    )


class _Strings:
    """The strings of one tree, in their order, and the nodes that come out of it."""

    def __init__(self, depth: int, start: tuple[int, int]):
        self.depth, self.start, self.turns = depth, start, 0
        self.conv, self.keys, self.goes_on = [], [], []
        self.tokens, self.high, self.low = [], [], []

    def add(self, conv: int, key: bytes, goes_on: bool, tokens, high, low) -> None:
        self.conv.append(conv)
        self.keys.append(key)
        self.goes_on.append(goes_on)
        self.tokens.append(tokens)
        self.high.append(high)
        self.low.append(low)
        self.turns += max(1, len(tokens))

    def _prefix(self, row: int, depth: int) -> tuple[int, int]:
        """The hash of the first ``depth`` turns of a string, with those of the bands before it."""
        lanes = zip(self.start, (self.high[row], self.low[row]), strict=True)
        return tuple(int(start ^ np.bitwise_xor.reduce(lane[:depth])) for start, lane in lanes)

    def nodes(self) -> list[tuple]:
        """Rows of NODE. Sums of a node to merge are over those children that are not to merge."""
        tree = Tree()
        for row, key in enumerate(self.keys):
            tree.insert(key, row)
        first, last = self.keys[0], self.keys[-1]
        out: list[list] = []
        below: dict[int, tuple] = {}
        for node, above, end in tree.postorder():
            results = [below.pop(id(child)) for _, child in node.children.items()]
            members = len(node.rows) + sum(r[0] for r in results)
            least = min([self.conv[row] for row in node.rows] + [r[1] for r in results])
            goes_on = any(self.goes_on[row] for row in node.rows) or any(r[2] for r in results)
            row = node.rows[0] if node.rows else results[0][3]
            tops = [top for r in results for top in r[4]]
            ends = sorted(self.conv[x] for x in node.rows if not self.goes_on[x])
            # the ends of turns on the edge to this node, the root's own start included
            for at in range(end - end % WIDTH, above - (node is tree.root), -WIDTH):
                merge = goes_on or any(len(edge) >= at and self.keys[row].startswith(edge[:at]) for edge in (first, last))
                tops = [self._emit(out, at // WIDTH, row, merge, members, least, ends if at == end else [], tops)]
            below[id(node)] = (members, least, goes_on, row, tops)
        return out

    def _emit(self, out: list[list], depth: int, row: int, merge: bool, members: int, least: int, ends: list[int], children: list[int]) -> int:
        continued = self.depth > 0 and depth == 0
        tokens = int(self.tokens[row][depth - 1]) if depth else 0
        joined = ",".join(map(str, ends))
        own = self._prefix(row, depth) if merge else (None, None)
        parent = self._prefix(row, depth - 1) if merge and depth else (None, None)
        done = [out[child] for child in children if not out[child][0]]
        n_leaves, saved = sum(child[10] for child in done), sum(child[11] for child in done)
        if not merge:
            n_leaves, saved = n_leaves + (not children), saved + (members - 1) * tokens
            joined = hashlib.sha256(joined.encode()).hexdigest()
        for child in done:
            if merge:
                child[4:6] = own
            else:
                child[7] = least
        out.append(
            [
                merge, self.depth + depth, *own, *parent, None if continued else least, None, 0 if continued else members,
                len(done), n_leaves, saved, tokens, ends[0] if merge and ends else None, joined,
            ]
        )
        return len(out) - 1


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The numbers of each row; without copying them one by one."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _trees(dealt: DataFrame, band: int, size: int) -> DataFrame:
    """Nodes of the strings, which come in their order; a tree is closed when it is full or its prefix ends."""
    fields = [part.split() for part in NODE.split(", ")]
    types = {"boolean": pa.bool_(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, types[kind]) for name, kind in fields])

    def table(strings: _Strings) -> pa.RecordBatch:
        columns = zip(*strings.nodes(), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema)

    def run(batches):
        now = None
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            plain = [column[name].to_pylist() for name in ("band", "start_high", "start_low", "conv_id", "key", "continues")]
            lists = [_lists(column[name]) for name in ("tokens", "high", "low")]
            for number, high, low, *string, tokens, highs, lows in zip(*plain, *lists, strict=True):
                if now is None or now.turns >= size or (now.depth, now.start) != (number * band, (high, low)):
                    if now is not None:
                        yield table(now)
                    now = _Strings(number * band, (high, low))
                now.add(*string, tokens, highs, lows)
        if now is not None:
            yield table(now)

    return map_batches(dealt, run, NODE)


def _digests(nodes: DataFrame) -> DataFrame:
    """SHA-256 of the ends of nodes to merge, whose pieces are read in order and not put together."""

    def run(batches):
        now, hashed = None, None
        for batch in batches:
            done = []
            for *node, _, ends in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if node != now:
                    if now:
                        done.append((*now, hashed.hexdigest()))
                    now, hashed = node, hashlib.sha256(ends.encode())
                else:
                    hashed.update(b"," + ends.encode())
            yield _hashed(done)
        if now:
            yield _hashed([(*now, hashed.hexdigest())])

    def _hashed(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*PREFIX, "digest"])

    pieces = nodes.filter("first_end IS NOT NULL").select(*PREFIX, "first_end", "ends")
    dealt = pieces.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "first_end")
    return map_batches(dealt, run, "depth long, high long, low long, digest string")


def _merged(nodes: DataFrame) -> DataFrame:
    """One row per node that had to be merged, finished but for the conversation of its parent."""
    total = nodes.groupBy(*PREFIX).agg(
        *(F.max(name).alias(name) for name in ("parent_high", "parent_low", "tokens")), F.min("conv_id").alias("conv_id"),
        *(F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    total = cut(total, "merged-nodes")
    over = [(F.col("depth") - 1).alias("depth"), F.col("parent_high").alias("high"), F.col("parent_low").alias("low")]
    more = total.filter("parent_high IS NOT NULL").groupBy(*over).agg(F.count("*").alias("more"))
    zero = F.lit(0).cast("long")
    total = total.join(more, PREFIX, "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", zero)).drop("more")
    total = total.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("tokens"),
            "up_high": F.col("parent_high"),
            "up_low": F.col("parent_low"),
        }
    )
    total, levels = cut(total, "merged-nodes"), 1
    deepest = total.agg(F.max("depth")).first()[0] or 0
    while levels <= deepest:
        total = cut(_doubled(total, levels), "merged-nodes")
        levels *= 2
    digests = _digests(nodes)
    none = hashlib.sha256(b"").hexdigest()
    return total.drop("up_high", "up_low").join(digests, PREFIX, "left").withColumn("ends_sha256", F.coalesce("digest", F.lit(none))).drop("digest")


def _doubled(total: DataFrame, levels: int) -> DataFrame:
    """Sums over less than ``levels`` levels become sums over twice as many; ``up`` is the ancestor so many levels above."""
    up = [(F.col("depth") - levels).alias("depth"), F.col("up_high").alias("high"), F.col("up_low").alias("low")]
    rising = total.filter(F.col("depth") >= levels)
    added = rising.groupBy(*up).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
    further = total.select(F.col("depth").alias("d"), F.col("high").alias("up_high"), F.col("low").alias("up_low"), F.col("up_high").alias("h"), F.col("up_low").alias("l"))
    found = total.withColumn("d", F.col("depth") - levels).join(further, ["d", "up_high", "up_low"], "left").drop("d", "up_high", "up_low")
    found = found.join(added, PREFIX, "left")
    zero = F.lit(0).cast("long")
    sums = {
        "n_leaves": F.col("n_leaves") + F.coalesce("more_leaves", zero),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("more_saved", zero),
    }
    return found.withColumns(sums).drop("more_leaves", "more_saved").withColumnsRenamed({"h": "up_high", "l": "up_low"})


def trie(turns: DataFrame, band: int = BAND, tree: int = TREE) -> DataFrame:
    """Every node of the trie over ``turns`` (``conv_id``, ``turn``, ``id``, ``tokens``; see ``digest``).

    A row with a null id only says that its conversation is there, perhaps without a turn. A node is known by its smallest
    member ``conv_id`` and its ``depth``; besides there are ``parent_conv_id`` (the parent's; null for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (nodes without children at or below it), ``saved_tokens`` (words of the last text
    for each member but one, over the nodes at or below it) and ``ends_sha256`` (of the members that end here, ascending,
    joined by commas).
    """
    strings = _strings(turns, band)
    order = ["band", "start_high", "start_low", "key", "conv_id"]
    dealt = strings.repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = cut(_trees(dealt, band, tree), "nodes")
    merged = cut(_merged(nodes.filter("merge")), "merged-nodes")
    parent = [(F.col("depth") + 1).alias("depth"), F.col("high").alias("parent_high"), F.col("low").alias("parent_low"), F.col("conv_id").alias("over")]
    parents = small(merged.select(*parent))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    done = nodes.filter("NOT merge").withColumnRenamed("ends", "ends_sha256")
    found = done.unionByName(merged.withColumn("parent_conv_id", F.lit(None).cast("long")), allowMissingColumns=True)
    found = found.join(parents, ["depth", "parent_high", "parent_low"], "left")
    return found.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "over")).select(*columns)


def conversations_trie(conversations: DataFrame) -> DataFrame:
    """The trie of a table of ``conv_id``, ``turn``, ``role`` and ``text``."""
    return trie(digest(conversations))
