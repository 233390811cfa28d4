"""Product codes of integer vectors; the nearest codebook entries are found in a GNAT.

Vectors become integers, are cut into equal parts, and every part is coded by its nearest entry of a small
codebook. The codebooks are trained by whole passes over the table: each task assigns its vectors and sends
one row of sums per entry, so a pass moves entries and never vectors.

A GNAT (geometric near-neighbor access tree) keeps, for every split point and every child, the least and the
greatest distance from the split point to the child's entries. A query's distance to a split point then rules
out whole children. All decisions are made on integers: distances are rounded down or up, whichever keeps
more, a child goes only if it is strictly farther than the best entry found, and the entries that stay are
compared by exact squared distances, ties by index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  gives pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.llm.common import saved_table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
SPLITS = 8
LEAF = 64
_SLICE = 4096
# Sums per entry and least ids are gathered from so many rows at most.
_GATHERED = 64


# -- the tree --------------------------------------------------------------------------------------


def squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """All squared distances, exact, as a matrix of longs."""
    out = np.zeros((len(queries), len(points)), np.int64)
    for d in range(queries.shape[1]):
        out += (queries[:, d, None] - points[None, :, d]) ** 2
    return out


def rounded_down(square: np.ndarray) -> np.ndarray:
    """A whole number that is at most the root; what lies beyond 2^50 is lowered by one, as its root may be rounded up."""
    return np.floor(np.sqrt(square.astype(np.float64))) - (square >= 1 << 50)


def rounded_up(square: np.ndarray) -> np.ndarray:
    """A whole number that is at least the root."""
    return np.ceil(np.sqrt(square.astype(np.float64))) + (square >= 1 << 50)


class Points:
    """Some entries, ascending, as a matrix that gives the distances to them in one product."""

    def __init__(self, points: np.ndarray, entries: np.ndarray):
        self.entries = entries
        self.here = points[entries]
        # (-2p, p.p): a query extended by a one times this is the squared distance less the query's own square.
        wide = np.vstack([-2 * self.here.T, (self.here * self.here).sum(1)])
        self.factors = {np.float32: wide.astype(np.float32), np.float64: wide.astype(np.float64)}


@dataclass
class Node:
    """Split points, a subtree per split point, and the ranges of distances ``near/far[split point, child]``."""

    splits: Points
    children: list[Node | Points | None]
    near: np.ndarray
    far: np.ndarray


def build(points: np.ndarray, entries: np.ndarray | None = None, n_splits: int = SPLITS, leaf: int = LEAF) -> Node | Points:
    """The tree over ``entries`` (ascending indices into ``points``, all by default).

    Split points are taken one after the other, each the entry farthest from those before it; every other
    entry goes to its nearest split point. Few entries, or entries that are all equal, are a leaf.
    """
    entries = np.arange(len(points)) if entries is None else entries
    if len(entries) <= max(leaf, n_splits):
        return Points(points, entries)
    chosen = [0]
    gap = squared(points[entries], points[entries[:1]])[:, 0]
    while len(chosen) < n_splits and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(points[entries], points[entries[chosen[-1:]]])[:, 0])
    if len(chosen) == 1:
        return Points(points, entries)
    splits = entries[sorted(chosen)]
    rest = np.delete(entries, chosen)
    distance = squared(points[rest], points[splits])
    owner = distance.argmin(axis=1)
    near = np.zeros((len(splits), len(splits)))
    far = np.full_like(near, -1)
    children: list[Node | Points | None] = []
    for j in range(len(splits)):
        own = owner == j
        children.append(build(points, rest[own], n_splits, leaf) if own.any() else None)
        if own.any():
            near[:, j] = rounded_down(distance[own].min(axis=0))
            far[:, j] = rounded_up(distance[own].max(axis=0))
    return Node(Points(points, splits), children, near, far)


class _Search:
    """The best entry so far of every query of a slice."""

    def __init__(self, points: np.ndarray, queries: np.ndarray):
        self.queries = queries
        self.own = (queries * queries).sum(1)
        # No sum on the way to a squared distance is longer than both vectors together, squared.
        most = (float(self.own.max(initial=0)) ** 0.5 + float((points * points).sum(1).max(initial=0)) ** 0.5) ** 2
        self.kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 51 else None
        if self.kind:
            self.wide = np.hstack([queries, np.ones((len(queries), 1))]).astype(self.kind)
        self.best = np.full(len(queries), np.iinfo(np.int64).max)
        self.entry = np.full(len(queries), len(points))
        self.compared = 0

    def look(self, rows: np.ndarray, at: Points) -> np.ndarray:
        """Distances to the entries, squared and less the query's own square; the better entry stays, of equal ones the lower."""
        found = self.wide[rows] @ at.factors[self.kind] if self.kind else squared(self.queries[rows], at.here) - self.own[rows, None]
        self.compared += found.size
        first = found.argmin(axis=1)
        least = found[np.arange(len(rows)), first].astype(np.int64) + self.own[rows]
        entry = at.entries[first]
        better = (least < self.best[rows]) | ((least == self.best[rows]) & (entry < self.entry[rows]))
        self.best[rows[better]], self.entry[rows[better]] = least[better], entry[better]
        return found

    def visit(self, node: Node | Points | None, rows: np.ndarray) -> None:
        if node is None or not len(rows):
            return
        if isinstance(node, Points):
            self.look(rows, node)
            return
        square = self.look(rows, node.splits).astype(np.int64) + self.own[rows, None]
        down, up = rounded_down(square), rounded_up(square)
        # Every query's nearest child first: a good best distance rules out more of the others.
        home = square.argmin(axis=1)
        for j, child in enumerate(node.children):
            self.visit(child, rows[home == j])
        reach = rounded_up(self.best[rows])[:, None]
        for j, child in enumerate(node.children):
            gap = np.maximum(down - node.far[:, j], node.near[:, j] - up)
            self.visit(child, rows[(gap <= reach).all(axis=1) & (home != j)])


def nearest(tree: Node | Points, points: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of every query's nearest point, ties to the lower index."""
    search = _Search(points, queries)
    search.visit(tree, np.arange(len(queries)))
    return search.entry, search.best


# -- vectors in tasks ------------------------------------------------------------------------------


def integers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a list column that are coded, and their floored components, one row each.

    Left out are null and empty vectors and those with a null, infinite or NaN component.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    usable = np.isfinite(values) if len(values) else np.zeros(0, bool)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    good = np.concatenate([[0], np.cumsum(usable)])
    rows = np.flatnonzero((lengths > 0) & (good[starts[1:]] - good[starts[:-1]] == lengths))
    if not len(rows):
        return rows, np.zeros((0, 0), np.int64)
    dims = int(lengths[rows[0]])
    if (lengths[rows] != dims).any():
        raise ValueError(f"vectors of different lengths: {dims} and {int(lengths[rows][lengths[rows] != dims][0])}")
    kept = np.floor(values[starts[rows][:, None] + np.arange(dims)] * scale)
    if 4 * float(np.abs(kept).max()) ** 2 * dims >= 1 << 62:
        raise ValueError(f"a component of {np.abs(kept).max() / scale}: squared distances would not fit a long")
    return rows, kept.astype(np.int64)


def _parts(vectors: np.ndarray, parts: int) -> np.ndarray:
    """``[part, row, component]``."""
    if vectors.shape[1] % parts:
        raise ValueError(f"vectors of {vectors.shape[1]} components cannot be cut into {parts} equal parts")
    return vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)


class Coder:
    """Trees over all codebooks, ``codebooks[part, entry, component]``."""

    def __init__(self, codebooks: np.ndarray):
        self.codebooks = codebooks
        self.trees = [build(book) for book in codebooks]

    def assigned(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``[part, row]``: the nearest entry of every part, and its squared distance."""
        parts = _parts(vectors, len(self.codebooks))
        if parts.shape[2] != self.codebooks.shape[2]:
            raise ValueError(f"vectors of {vectors.shape[1]} components, codebooks of {self.codebooks[:, 0].size}")
        codes = np.empty(parts.shape[:2], np.int64)
        errors = np.empty(parts.shape[:2], np.int64)
        for start in range(0, len(vectors), _SLICE):
            here = slice(start, start + _SLICE)
            for p, (tree, book) in enumerate(zip(self.trees, self.codebooks)):
                codes[p, here], errors[p, here] = nearest(tree, book, parts[p, here])
        return codes, errors


def _least(found: dict, wanted: int) -> dict:
    return {key: found[key] for key in sorted(found)[:wanted]}


def _least_rows(batches: Iterator[pa.RecordBatch], wanted: int, scale: int) -> Iterator[pa.RecordBatch]:
    """One vector for each of the least ids of all batches; of one id the least vector."""
    found: dict = {}
    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        rows, vectors = integers(batch.column(1), scale)
        ids = batch.column(0).to_pylist()
        top = max(found) if len(found) == wanted else None
        for row, vector in zip(rows.tolist(), vectors):
            key = ids[row]
            if key is not None and (top is None or key <= top):
                new = tuple(vector.tolist())
                found[key] = min(found.get(key, new), new)
        found = _least(found, wanted)
    if found:
        columns = [pa.array(list(found), kind), pa.array([list(v) for v in found.values()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "vector"])


def first_vectors(rows: DataFrame, wanted: int, scale: int = SCALE) -> np.ndarray:
    """The integer vectors of the least ids of ``rows`` (``id, vector``), ascending.

    Every task hands on its own least ids; while there are more than 64 times the wanted rows, they are dealt
    to fewer tasks and thinned out again, so neither a task nor the driver gets more than that.
    """
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, vector array<long>"
    found = saved_table(rows.mapInArrow(lambda b: _least_rows(b, wanted, scale), schema), "least")
    n = found.count()
    while n > _GATHERED * wanted:
        fewer = found.repartition(-(-n // (_GATHERED * wanted)))
        found = saved_table(fewer.mapInArrow(lambda b: _least_rows(b, wanted, 1), schema), "least")
        n = found.count()
    least: dict = {}
    for r in found.collect():
        new = tuple(r.vector)
        least[r.id] = min(least.get(r.id, new), new)
    return np.array(list(_least(least, wanted).values()), np.int64)


def _sums(batches: Iterator[pa.RecordBatch], coder: Coder, scale: int) -> Iterator[pa.RecordBatch]:
    """Per part and entry the number of its vectors and their sum, of all batches of a task."""
    n_parts, n_entries, width = coder.codebooks.shape
    total = np.zeros((n_parts, n_entries, width + 1), np.int64)
    for batch in batches:
        rows, vectors = integers(batch.column(0), scale)
        if not len(rows):
            continue
        codes, _ = coder.assigned(vectors)
        for p, part in enumerate(_parts(vectors, n_parts)):
            total[p, :, 0] += np.bincount(codes[p], minlength=n_entries)
            for d in range(width):
                # Below 2^53 a batch's sum of whole numbers is exact in a double.
                total[p, :, d + 1] += np.bincount(codes[p], part[:, d], n_entries).astype(np.int64)
    p, e = np.nonzero(total[:, :, 0])
    columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), *[pa.array(total[p, e, d]) for d in range(width + 1)]]
    yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", *[f"s{d}" for d in range(width)]])


def train_codebooks(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> np.ndarray | None:
    """``[part, entry, component]`` from ``rows`` (``id, vector``), or None if no vector is usable.

    The codebooks start as the vectors of the least ids. Each round assigns all vectors and replaces an entry
    by the floor of its vectors' mean; an entry without vectors stays. A round returns one row per entry
    to the driver, whatever the number of vectors.
    """
    first = first_vectors(rows, entries, scale)
    if not len(first):
        return None
    books = np.ascontiguousarray(_parts(first, parts))
    width = books.shape[2]
    sums = [f"s{d}" for d in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)
    for _ in range(rounds):
        coder = Coder(books)
        found = rows.select("vector").mapInArrow(lambda b, c=coder: _sums(b, c, scale), schema)
        books = books.copy()
        for r in found.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ["n", *sums]]).collect():
            books[r.part, r.entry] = [r[s] // r.n for s in sums]
    return books


def _coded(batches: Iterator[pa.RecordBatch], coder: Coder, scale: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors = integers(batch.column("vector"), scale)
        if not len(rows):
            continue
        codes, errors = coder.assigned(vectors)
        data = codes.T.astype(np.uint8).tobytes()
        width = len(coder.codebooks)
        kept = batch.select(["id", "label"]).take(pa.array(rows))
        code = pa.array([data[i : i + width] for i in range(0, len(data), width)], pa.binary())
        yield pa.RecordBatch.from_arrays([*kept.columns, code, pa.array(errors.sum(axis=0))], ["id", "label", "code", "error"])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def product_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    codebooks: np.ndarray | None = None,
) -> DataFrame:
    """``id_col, label_col, code, error, label_error, codebooks_sha256`` of every usable vector.

    ``code`` (binary) has a byte per part, ``error`` is the sum of the parts' squared distances to their
    entries and ``label_error`` that over all vectors of equal label, those without a label together.
    ``codebooks`` of an earlier run are used as they are.

    Left out are null and empty vectors and those with a null, NaN or infinite component. Vectors of
    different lengths, of a length that ``parts`` does not divide, or so large that a squared distance does
    not fit a long raise an error. A vector without an id is coded and never starts an entry; rows that
    share an id are all coded and the least of them starts one entry. Fewer ids than ``entries`` make
    smaller codebooks; an empty table, or one without usable vectors, gives an empty result. Further columns
    are ignored. Equal vectors, labels and entries need no care: nothing is gathered by them but sums.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has a byte per part: entries must be 1 to 256")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    books = train_codebooks(rows.select("id", "vector"), parts, entries, rounds, scale) if codebooks is None else codebooks
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, code binary, error long"
    named = [F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error"]
    if books is None:
        empty = vectors.sparkSession.createDataFrame([], schema).select(*named)
        return empty.withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")})
    coder = Coder(books)
    coded = saved_table(rows.mapInArrow(lambda b: _coded(b, coder, scale), schema), "codes")
    sums = saved_table(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "errors")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(*named, "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
