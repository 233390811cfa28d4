"""A trie of conversation prefixes, built from sorted shards and the skeleton of their splitters.

A conversation's path is the list of its turns' hashes. Sorted by path, then id, the members of every trie
node stand next to each other. Splitters taken from a sample cut that order into shards; the trie of the
splitters' own paths, the skeleton, goes to every task. A node that is not in it lies within one shard, which
finishes it while it reads its sorted rows once. For nodes of the skeleton every shard hands on partial
aggregates, which are summed, and the skeleton, bounded in size, is finished from the bottom up.

The id is part of the order, so conversations that are all equal are spread over shards like any others.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casecurve.llm.common import saved_table, shuffle_partitions

# Shards times turns of a splitter's path: the most nodes that a skeleton can have.
SKELETON_NODES = 1 << 18
_SAMPLES = 16
# Ids of one node's ends that a shard joins to one row.
_BLOCK = 1 << 16
_OUT_ROWS = 4096

_NODE, _PART, _ENDS = 0, 1, 2
_SCHEMA = (
    "kind int, node int, conv long, depth long, parent_conv long, parent_node int, chars long, "
    "n_convs long, n_children long, n_leaves long, saved long, ends string"
)


# -- paths -----------------------------------------------------------------------------------------


def turn_lists(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv, turns``: every conversation's turns in order as ``h1, h2`` (128 bits of role and text) and ``chars``.

    Ordered by turn, null first, then by role and text; null roles and texts are empty. Equal rows are
    turns of their own. Rows without a conversation are left out. Texts are hashed before they are gathered:
    a conversation is one row of 24 bytes a turn.
    """
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).filter("conv IS NOT NULL")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    hashed = rows.select(
        "conv",
        F.row_number().over(order).alias("pos"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "role", "text").alias("h2"),
        F.char_length("text").cast("long").alias("chars"),
    )
    listed = F.array_sort(F.collect_list(F.struct("pos", "h1", "h2", "chars")))
    return hashed.groupBy("conv").agg(F.transform(listed, lambda t: F.struct(t["h1"], t["h2"], t["chars"])).alias("turns"))


def regrown(lists: DataFrame, group: int, own_from: Column) -> DataFrame:
    """``conv, turns``: every conversation begins with turns of the first conversation of its group.

    That is the one with ``conv - conv % group`` as its id. Its first ``own_from`` turns (all if it has
    fewer, none if there is no such conversation) are followed by the conversation's own turns after its
    first ``own_from``. A group has at most ``2 * group`` ids, so the join has no hot key.
    """
    stem = F.col("conv") - F.col("conv") % group
    # Never empty, so that a missing stem and one without turns are the same thing.
    stems = lists.filter(F.col("conv") % group == 0).select(F.col("conv").alias("stem"), F.col("turns").alias("of_stem"))
    rows = lists.withColumns({"stem": stem, "own_from": own_from}).join(stems, "stem", "left")
    head = F.slice(F.col("of_stem"), 1, F.col("own_from"))
    rest = F.slice(F.col("turns"), F.col("own_from") + 1, F.size("turns"))
    none = F.array().cast("array<struct<h1:long,h2:long,chars:long>>")
    return rows.select("conv", F.concat(F.coalesce(head, none), F.coalesce(rest, none)).alias("turns"))


# -- skeleton --------------------------------------------------------------------------------------


@dataclass
class Skeleton:
    """The trie of the splitters' paths: ``below[node]`` maps the next turn's hashes to a child node; 0 is the root."""

    splitters: list[tuple[tuple[int, ...], int]]
    below: list[dict[tuple[int, int], int]] = field(default_factory=lambda: [{}])
    above: list[int] = field(default_factory=lambda: [-1])

    def __post_init__(self) -> None:
        for path, _ in self.splitters:
            at = 0
            for i in range(0, len(path), 2):
                step = path[i], path[i + 1]
                if step not in self.below[at]:
                    self.below[at][step] = len(self.below)
                    self.below.append({})
                    self.above.append(at)
                at = self.below[at][step]


def skeleton_of(paths: DataFrame, n_shards: int, nodes: int = SKELETON_NODES) -> Skeleton:
    """Splitters for ``n_shards`` shards of about equal numbers of conversations, from a sample of ids by hash.

    A splitter's path is cut after ``nodes / n_shards`` turns. Nodes deeper than that still lie within one
    shard, as all their members are on the same side of such a splitter.
    """
    n = paths.count()
    deepest = max(1, nodes // n_shards)
    wanted = _SAMPLES * n_shards
    sample = paths if n <= wanted else paths.filter(F.pmod(F.xxhash64("conv"), F.lit(n)) < wanted)
    found = sample.select(F.slice("path", 1, 2 * deepest).alias("path"), "conv").collect()
    keys = sorted((tuple(r.path), r.conv) for r in found)
    return Skeleton(sorted({keys[i * len(keys) // n_shards] for i in range(1, n_shards)} if keys else []))


def _dealt(batches: Iterator[pa.RecordBatch], splitters: list) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = zip(batch.column("path").to_pylist(), batch.column("conv").to_pylist())
        shard = pa.array([bisect_right(splitters, (tuple(path), conv)) for path, conv in keys], pa.int32())
        yield pa.RecordBatch.from_arrays([shard, *batch.columns], ["shard", *batch.schema.names])


# -- shards ----------------------------------------------------------------------------------------


class _Open:
    """A node on the path of the current conversation."""

    __slots__ = ("depth", "chars", "node", "conv", "n", "children", "leaves", "saved", "ends", "first", "ids", "waiting")

    def __init__(self, depth: int, chars: int, node: int | None):
        self.depth, self.chars, self.node = depth, chars, node
        self.conv: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.ends = hashlib.sha256()
        self.first: int | None = None
        self.ids: list[int] = []
        self.waiting: list[tuple] = []


class _Shard:
    """Reads conversations sorted by path and id, and gives the rows of nodes that are done."""

    def __init__(self, below: list[dict[tuple[int, int], int]]):
        self.below = below
        self.out: list[tuple] = []
        self.restart()

    def restart(self) -> None:
        self.path: list[tuple[int, int]] = []
        self.stack = [_Open(0, 0, 0)]

    def add(self, conv: int, path: list[tuple[int, int]], chars: list[int]) -> None:
        same = 0
        for a, b in zip(path, self.path):
            if a != b:
                break
            same += 1
        while len(self.stack) > same + 1:
            self._close()
        for i in range(same, len(path)):
            node = self.stack[-1].node
            self.stack.append(_Open(i + 1, chars[i], None if node is None else self.below[node].get(path[i])))
        self.path = path
        end = self.stack[-1]
        end.n += 1
        end.conv = conv if end.conv is None else min(end.conv, conv)
        if end.node is None:
            end.ends.update(f",{conv}".encode() if end.first is not None else str(conv).encode())
            end.first = conv
        else:
            end.ids.append(conv)
            if len(end.ids) == _BLOCK:
                self._hand_on_ends(end)

    def _hand_on_ends(self, open_: _Open) -> None:
        if open_.ids:
            row = (_ENDS, open_.node, open_.ids[0], None, None, None, None, None, None, None, None, ",".join(map(str, open_.ids)))
            self.out.append(row)
            open_.ids = []

    def _close(self) -> None:
        done = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if above is not None:
            above.n += done.n
            above.conv = done.conv if above.conv is None else min(above.conv, done.conv)
        # The children of a node learn its least member when it is done.
        self.out += [(_NODE, None, *row[:2], done.conv, None, *row[2:]) for row in done.waiting]
        if done.node is not None:
            self._hand_on_ends(done)
            counts = (done.n, done.children, done.leaves, done.saved)
            self.out.append((_PART, done.node, done.conv, done.depth, None, None, done.chars, *counts, None))
            return
        leaves = done.leaves if done.children else 1
        saved = done.saved + (done.n - 1) * done.chars
        row = (done.conv, done.depth, done.chars, done.n, done.children, leaves, saved, done.ends.hexdigest())
        if above.node is None:
            above.waiting.append(row)
        else:
            self.out.append((_NODE, None, *row[:2], None, above.node, *row[2:]))
        above.children += 1
        above.leaves += leaves
        above.saved += saved

    def end(self) -> None:
        """The shard is read: all nodes are done."""
        while self.stack:
            self._close()
        self.restart()


def _shard_rows(batches: Iterator[pa.RecordBatch], below: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    state, current = _Shard(below), None

    def taken() -> Iterator[pa.RecordBatch]:
        for start in range(0, len(state.out), _OUT_ROWS):
            rows = state.out[start : start + _OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        state.out = []

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "conv", "path", "chars"))
        for shard, conv, path, chars in zip(*columns):
            if shard != current:
                if current is not None:
                    state.end()
                current = shard
            state.add(conv, list(zip(path[::2], path[1::2])), chars)
            if len(state.out) >= _OUT_ROWS:
                yield from taken()
    if current is not None:
        state.end()
    yield from taken()


def _joined_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of every node's ids from its blocks, which come in order."""
    found: dict[int, object] = {}
    for batch in batches:
        for node, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if node in found:
                found[node].update(b",")
            else:
                found[node] = hashlib.sha256()
            found[node].update(ends.encode())
    digests = [d.hexdigest() for d in found.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(digests, pa.string())], ["node", "ends"])


def _finished(parts: dict[int, dict], skeleton: Skeleton, ends: dict[int, str]) -> list[tuple]:
    """The skeleton's nodes from the sums of their partial aggregates; children come after their parents in the numbering."""
    rows = []
    for node in range(len(skeleton.below) - 1, -1, -1):
        p = parts[node]
        p["n_children"] += len(skeleton.below[node])
        if not p["n_children"]:
            p["n_leaves"] = 1
        p["saved"] += (p["n_convs"] - 1) * p["chars"] if node else 0
        parent = skeleton.above[node]
        if node:
            parts[parent]["n_leaves"] += p["n_leaves"]
            parts[parent]["saved"] += p["saved"]
        above = parts[parent]["conv"] if node else None
        counts = (p["n_convs"], p["n_children"], p["n_leaves"], p["saved"])
        rows.append((node, p["conv"], p["depth"], above, *counts, ends.get(node, hashlib.sha256().hexdigest())))
    return rows


def prefix_trie(lists: DataFrame, n_shards: int | None = None, skeleton_nodes: int = SKELETON_NODES) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every trie node.

    ``lists`` has ``conv`` (long, each once) and ``turns`` (as ``turn_lists`` gives them). A node is a distinct
    sequence of first turns, from the empty one of the root; its members are the conversations that begin
    with it. ``conv_id`` is the least member, ``parent_conv_id`` that of the node one turn shorter (null for
    the root), ``n_leaves`` counts childless nodes of the subtree with its top, ``saved_tokens`` sums over
    the subtree each node's members less one times the characters of its last turn, and ``ends_sha256`` is
    the hash of the ids of the members that end there, ascending, joined by commas.

    A conversation without turns is a member of the root. An empty table has no nodes. Equal turns are told
    by 128 bits of their hash. Conversations that are all alike are cut by id into as many shards as others;
    only the digest of the ids that end at one node is made in one task, from rows of up to 65,536 ids each.
    A shard holds one conversation's path and the children of the nodes on it that are not done.
    """
    spark = lists.sparkSession
    n_shards = n_shards or shuffle_partitions(spark)
    flat = F.flatten(F.transform("turns", lambda t: F.array(t["h1"], t["h2"])))
    chars = F.transform("turns", lambda t: t["chars"])
    paths = saved_table(lists.select("conv", flat.alias("path"), chars.alias("chars")), "paths")
    skeleton = skeleton_of(paths, n_shards, skeleton_nodes)
    shared = spark.sparkContext.broadcast((skeleton.splitters, skeleton.below))
    dealt = paths.mapInArrow(lambda b: _dealt(b, shared.value[0]), "shard int, conv long, path array<long>, chars array<long>")
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _SCHEMA.split(", "))])
    # The shards are numbered in order and of about equal size, so ranges of numbers are even partitions.
    ordered = dealt.repartitionByRange(n_shards, "shard").sortWithinPartitions("shard", "path", "conv")
    rows = saved_table(ordered.mapInArrow(lambda b: _shard_rows(b, shared.value[1], schema), _SCHEMA), "nodes")

    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    parts = rows.filter(F.col("kind") == _PART).groupBy("node")
    summed = parts.agg(F.min("conv").alias("conv"), F.max("depth").alias("depth"), F.max("chars").alias("chars"), *[F.sum(c).alias(c) for c in sums])
    blocks = rows.filter(F.col("kind") == _ENDS).select("node", "conv", "ends")
    ends = blocks.repartition("node").sortWithinPartitions("node", "conv").drop("conv").mapInArrow(_joined_ends, "node int, ends string")
    # One row for each node of the skeleton, so at most ``skeleton_nodes``.
    found = {r["node"]: r.asDict() for r in summed.collect()}
    names = ["conv", "depth", "parent_conv", *sums, "ends"]
    tops = "node int, conv long, depth long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long, ends string"
    done = _finished(found, skeleton, {r.node: r.ends for r in ends.collect()}) if found else []
    top = saved_table(spark.createDataFrame(done, tops), "skeleton")
    parents = top.select(F.col("node").alias("parent_node"), F.col("conv").alias("of_parent"))
    low = rows.filter(F.col("kind") == _NODE).join(F.broadcast(parents), "parent_node", "left")
    low = low.withColumn("parent_conv", F.coalesce("parent_conv", "of_parent")).select(names)
    both = low.unionByName(top.select(names))
    return both.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        *sums[:3],
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )
