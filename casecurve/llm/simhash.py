"""SimHash near-duplicates, linked through BK-trees.

Fingerprints are counted once each, however many documents share one. Two fingerprints within radius r
agree on at least one of r + 1 bands of their bits, so each band value is a shard and a shard's BK-tree
finds all links of that band. A shard is built and searched where the shuffle brought it: all trees
together grow with the data, so they are not sent to every task. A shard with more fingerprints than one
tree may hold is cut into parts with a tree each, and every two parts meet in a task of bounded size.

A tree keeps its children keyed by their distance to the parent; a search follows only children whose key
is within the radius of its own distance. All trees of a block of rows are built and searched together,
level by level, in numpy. What leaves a block is a spanning forest of the links found in it, not every pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import keyed, pieces_of, row_key, saved_table
from casecurve.llm.components import components

SHINGLE = 3
RADIUS = 2
TREE_SIZE = 16384
_BLOCK = 65536
_FRONTIER = 1 << 20


# -- fingerprints -----------------------------------------------------------------------------------


def simhash(text: str, shingle: int = SHINGLE, seed: int = 42) -> int:
    """64 bits, each 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    words = text.encode().lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    data, ends = b" ".join(words), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(data[i:j], seed) for i, j in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, len(words) - shingle + 1
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id, row, fp``: the fingerprint as a signed long; ``row`` tells apart rows of one id with different texts."""
    rows = keyed(docs, id_col, text_col).select("id", row_key(F.col("text")).alias("row"), "text")

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of([batch], "text", 16 << 20):
                fps = np.array([simhash(t, shingle) for t in piece.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([*piece.select(["id", "row"]).columns, pa.array(fps.view(np.int64))], names=["id", "row", "fp"])

    return rows.mapInArrow(hashed, f"id {rows.schema['id'].dataType.simpleString()}, row bigint, fp bigint")


# -- BK-trees ---------------------------------------------------------------------------------------


class Forest:
    """BK-trees over ``fps``, one for each value of ``tree``; nodes of a tree have different fingerprints."""

    def __init__(self, fps: np.ndarray, tree: np.ndarray) -> None:
        n = len(fps)
        self.fps, self.key, parent = fps, np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        roots, first, of = np.unique(tree, return_index=True, return_inverse=True)
        self.root = dict(zip(roots.tolist(), first.tolist()))
        rest, at = np.arange(n), first[of]
        while True:
            below = rest != at
            rest, at = rest[below], at[below]
            if not len(rest):
                break
            # All nodes still on their way down meet the child of their parent at their distance: the first makes it.
            distance = np.bitwise_count(fps[rest] ^ fps[at]).astype(np.int64)
            _, first, of = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            child = rest[first]
            parent[child], self.key[child] = at[first], distance[first]
            at = child[of]
        inner = np.flatnonzero(parent >= 0)
        self.children = inner[np.lexsort((self.key[inner], parent[inner]))]
        # Children lie by parent and key, so those within the radius of a distance are one run.
        self.place = parent[self.children] * 65 + self.key[self.children]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, for query i from root ``roots[i]``; some at a time."""
        stack = [(np.arange(len(queries)), roots)]
        while stack:
            query, node = stack.pop()
            if len(query) > _FRONTIER:
                stack.append((query[_FRONTIER:], node[_FRONTIER:]))
                query, node = query[:_FRONTIER], node[:_FRONTIER]
            distance = np.bitwise_count(queries[query] ^ self.fps[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.place, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.place, node * 65 + np.minimum(distance + radius, 64), "right")
            many = high - low
            if many.sum():
                query = np.repeat(query, many)
                shift = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                stack.append((query, self.children[np.repeat(low, many) + shift]))


def spanning(size: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index each of ``size`` items is joined to by the pairs."""
    label = np.arange(size)
    for a, b in pairs:
        while True:
            x, y = label[a], label[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            if not len(a):
                break
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _linked(block: list[pa.RecordBatch], radius: int) -> pa.RecordBatch:
    whole = pa.Table.from_batches(block)
    band, value, sub, fp, node = (whole.column(c).to_numpy() for c in ("band", "value", "sub", "fp", "node"))
    fp = np.ascontiguousarray(fp).view(np.uint64)
    _, tree = np.unique(np.stack([band, value, sub]), axis=1, return_inverse=True)
    _, item = np.unique(fp, return_inverse=True)
    tree, node = tree.ravel(), node.astype(bool)
    nodes = np.flatnonzero(node)
    forest = Forest(fp[nodes], tree[nodes])
    rooted = np.flatnonzero(np.isin(tree, tree[nodes]))
    roots = np.array([forest.root[t] for t in tree[rooted].tolist()], np.int64)
    found = ((item[rooted[q]], item[nodes[n]]) for q, n in forest.search(fp[rooted], roots, radius))
    label = spanning(int(item.max()) + 1, found)
    distinct = np.unique(fp).view(np.int64)
    joined = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(distinct[joined]), pa.array(distinct[label[joined]])], names=["a", "b"])


def links(fps: DataFrame, radius: int = RADIUS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``a, b``: edges whose components are those of all pairs of distinct ``fp`` within ``radius`` bits.

    ``fps`` is read twice and should be a saved table of distinct fingerprints.
    """
    if not 0 <= radius < 64:
        raise ValueError("the radius is from 0 to 63 bits")
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    parts = [
        F.struct(
            F.lit(i).alias("band"),
            F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << min(high - low, 63)) - 1).cast("long")).alias("value"),
        )
        for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
    ]
    placed = fps.select("fp", F.explode(F.array(*parts)).alias("p")).select("fp", "p.band", "p.value")
    # Saved, so that the join can split the rows of a large shard.
    sizes = saved_table(placed.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shards")
    # Fingerprints alone in a shard have no partner in this band and are not moved on.
    # A shard of several trees is cut into parts; part i's tree is searched by itself and by each later part.
    trees = F.ceil(F.col("n") / F.lit(tree_size)).cast("int")
    spread = (
        placed.join(sizes, ["band", "value"])
        .withColumn("trees", trees)
        .withColumn("own", F.pmod(F.xxhash64("fp"), "trees").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
        .withColumn("first", F.least("own", "other"))
        .select(
            "band",
            "value",
            (F.col("first").cast("long") * F.col("trees") + F.greatest("own", "other")).alias("sub"),
            "fp",
            (F.col("own") == F.col("first")).alias("node"),
        )
    )
    together = spread.repartition("band", "value", "sub").sortWithinPartitions("band", "value", "sub")

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            ids = [batch.column(c).to_numpy() for c in ("band", "value", "sub")]
            if held and size >= _BLOCK:
                # A block ends with a whole tree.
                last = [held[-1].column(c)[-1].as_py() for c in ("band", "value", "sub")]
                other = np.flatnonzero(~np.logical_and.reduce([x == y for x, y in zip(ids, last)]))
                cut = int(other[0]) if len(other) else len(ids[0])
                if cut < len(ids[0]):
                    yield _linked([*held, batch.slice(0, cut)] if cut else held, radius)
                    held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
        if size:
            yield _linked(held, radius)

    return together.mapInArrow(linked, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tree_size: int = TREE_SIZE,
) -> DataFrame:
    """``id_col, row, fp, component_id, stays``: the smallest id a document reaches over links of ``radius`` bits.

    ``stays`` marks one row of each component: that of the smallest id, and of rows with this id the one
    whose text has the smallest hash ``row`` (all of them, if they are equal in both).

    A null or empty text has the fingerprint 0 and is linked like any other. Repeated rows come out as
    often as they went in. A row without an id belongs to its component but never names it, unless no row
    of it has an id (then the component is null). A very long text is hashed whole by one task, and only
    its fingerprint goes further. An empty table gives no rows.
    """
    marked = saved_table(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    head = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("head")
    distinct = saved_table(marked.groupBy("fp").agg(head), "distinct")
    joined = saved_table(components(links(distinct.select("fp"), radius, tree_size)), "components")
    named = distinct.join(joined, distinct["fp"] == joined["node"]).groupBy("component").agg(F.min("head").alias("reached"))
    linked = joined.join(named, "component").select(F.col("node").alias("fp"), "reached")
    # Saved, so that the join can split the rows of a fingerprint that many documents share.
    classes = saved_table(distinct.join(linked, "fp", "left").select("fp", F.coalesce("reached", "head").alias("head")), "classes")
    return marked.join(classes, "fp").select(
        F.col("id").alias(id_col),
        "row",
        "fp",
        F.col("head.id").alias("component_id"),
        (F.col("id").eqNullSafe(F.col("head.id")) & (F.col("row") == F.col("head.row"))).alias("stays"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component, of equal rows too."""
    found = near_duplicates(docs, id_col, text_col, **options)
    stay = found.filter("stays").select(F.col(id_col).alias("id"), "row").distinct()
    whole = keyed(docs, id_col, text_col, docs.columns).select("id", row_key(F.col("text")).alias("row"), "rest")
    left = whole.join(stay, whole["id"].eqNullSafe(stay["id"]) & (whole["row"] == stay["row"]), "left_semi")
    return left.groupBy("id", "row").agg(F.first("rest").alias("rest")).select("rest.*")
