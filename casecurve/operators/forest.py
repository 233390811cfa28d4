"""Deep random forests of many rows: large nodes by sums over all tasks, each small one with all below it by one task.

A forest nearly without a bound on its depth has about as many nodes as rows. Were sums of every node to come
from every task, what is sent would grow with nodes times tasks. Here only nodes of more than ``NODE_ROWS`` different rows
are split that way, a level of all trees in one job. The rows below every other node meet once in one task.

Features are seen as at most 32 bins, so equal rows are one row with a count, and a sum of their Poisson draws is one draw
of that mean. Draws and the features tried at a node are hashes of the row, the tree and the node: a forest does not
depend on how the rows lie. Splits are by Gini impurity; two leaves of one decision are merged, as in Spark ML.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.session import saved_table, scratch_path
from casecurve.sources.snapshots import located

BINS = 32
# Different rows of a tree's sample below which a node is finished by one task, and the most of a task that adds up sums.
NODE_ROWS, SHARE_ROWS = 1 << 15, 1 << 18
# Rows that are scored together, and cells of the sums that are looked at together.
SCORE_ROWS, SUM_CELLS = 1 << 18, 1 << 20
_EPS = 1e-12
_SUMS = "tree int, slot int, sums binary"
_SPLITS = "tree int, slot int, feature int, cut int, lower array<double>, upper array<double>"
_ROWS = "tree int, slot int, x binary, y binary, n binary"
_NODES = "tree int, slot int, size int, feature binary, cut binary, child binary, value binary"


@dataclass(frozen=True)
class Plan:
    """What all tasks know: ``weights`` are those of the classes."""

    trees: int
    depth: int
    least: int
    seed: int
    width: int
    weights: np.ndarray

    @property
    def tried(self) -> int:
        return math.ceil(math.sqrt(self.width))

    @property
    def classes(self) -> int:
        return len(self.weights)


@dataclass
class Nodes:
    """A tree as arrays. ``child`` is the left child, the right one follows it; 0 for a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    def reached(self, x: np.ndarray) -> np.ndarray:
        at, live = np.zeros(len(x), np.int32), np.arange(len(x))
        while len(live):
            node = at[live]
            inner = self.child[node] > 0
            live, node = live[inner], node[inner]
            at[live] = self.child[node] + (x[live, self.feature[node]] > self.cut[node])
        return at


def _mixed(values: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit numbers (splitmix64)."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _salt(seed: int, tree: int, use: int) -> np.uint64:
    return _mixed(_mixed(np.array([seed * 4 + use], np.int64).view(np.uint64)) + np.uint64(tree))[0]


def poisson_cut_points(mean: int) -> tuple[int, np.ndarray]:
    """The least count worth a draw and the distribution function from it on."""
    reach = 12.0 * math.sqrt(mean) + 20.0
    low = max(0, int(mean - reach))
    steps = np.log(mean) - np.log(np.arange(low + 1, int(mean + reach)))
    first = low * math.log(mean) - mean - math.lgamma(low + 1)
    return low, np.cumsum(np.exp(first + np.concatenate([[0.0], np.cumsum(steps)])))


def drawn(keys: np.ndarray, groups: list[tuple[int, np.ndarray, np.ndarray]], seed: int, tree: int) -> np.ndarray:
    """How often a tree's sample holds each row; ``groups`` are the rows of one count with their distribution."""
    share = (_mixed(keys ^ _salt(seed, tree, 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    out = np.zeros(len(keys))
    for low, rows, points in groups:
        out[rows] = low + np.searchsorted(points, share[rows], side="right")
    return out


def tried_features(paths: np.ndarray, tree: int, plan: Plan) -> np.ndarray:
    """``[node, tried]``: the features of least hash at each node."""
    if plan.tried >= plan.width:
        return np.tile(np.arange(plan.width), (len(paths), 1))
    hashes = _mixed(_mixed(paths.astype(np.uint64) ^ _salt(plan.seed, tree, 2))[:, None] + np.arange(plan.width, dtype=np.uint64))
    return np.argpartition(hashes, plan.tried - 1, axis=1)[:, : plan.tried]


def best_cuts(sums: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain and the bin of the best cut, and the sums under it, for ``sums[node, bin, class, ...]`` of one feature.

    What follows the classes is added up, too, but has no say.
    """
    k = plan.classes
    under = np.cumsum(sums, axis=1)
    whole = under[:, -1:, :k]
    lower = under[:, :-1, :k]
    upper = whole - lower
    weighted, rest, everything = lower * plan.weights, upper * plan.weights, whole * plan.weights
    a, b, s = weighted.sum(2), rest.sum(2), everything.sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (np.square(weighted).sum(2) / a + np.square(rest).sum(2) / b - np.square(everything).sum(2) / s) / s
    fits = (lower.sum(2) >= max(1, plan.least)) & (upper.sum(2) >= max(1, plan.least))
    gain = np.where(fits, gain, -1.0)
    cut, node = gain.argmax(1), np.arange(len(sums))
    return gain[node, cut], cut, under[node, cut]


def open_nodes(counts: np.ndarray) -> np.ndarray:
    """Nodes with rows of more than one class."""
    return (counts > 0).sum(1) > 1


def grow(x: np.ndarray, y: np.ndarray, n: np.ndarray, tree: int, path: int, depth: int, plan: Plan) -> tuple[Nodes, np.ndarray]:
    """The subtree of a node at ``depth`` and the classes' shares at each of its nodes, from the rows in it."""
    k = plan.classes
    counts = [np.bincount(y, weights=n, minlength=k)[None, :]]
    feature, cut, child = [np.zeros(1, np.int16)], [np.zeros(1, np.uint8)], [np.zeros(1, np.int32)]
    # Of each level: number of its first node; of the open nodes the place in the level and the path.
    first, level, splits = 0, 0, []
    at = np.flatnonzero(open_nodes(counts[0]))
    paths = np.array([path], np.int64)[at]
    rows, place = np.arange(len(y)) if len(at) else np.arange(0), np.zeros(len(y) if len(at) else 0, np.int64)
    while len(at) and depth + level < plan.depth:
        tried = tried_features(paths, tree, plan)
        order = np.argsort(place, kind="stable")
        rows, place = rows[order], place[order]
        gain, chosen = np.zeros(len(at)), np.zeros(len(at), np.int16)
        bins, lower = np.zeros(len(at), np.uint8), np.zeros((len(at), k))
        step = max(1, SUM_CELLS // (BINS * k))
        for start in range(0, len(at), step):
            stop = min(len(at), start + step)
            i, j = np.searchsorted(place, [start, stop])
            here, base, yy, nn = rows[i:j], (place[i:j] - start) * BINS, y[rows[i:j]], n[rows[i:j]]
            for s in range(tried.shape[1]):
                seen = x[here, tried[place[i:j], s]]
                sums = np.bincount((base + seen) * k + yy, weights=nn, minlength=(stop - start) * BINS * k)
                g, c, under = best_cuts(sums.reshape(stop - start, BINS, k), plan)
                better = np.flatnonzero(g > gain[start:stop])
                gain[start + better], chosen[start + better] = g[better], tried[start + better, s]
                bins[start + better], lower[start + better] = c[better], under[better]
        split = gain > _EPS
        number = np.cumsum(split) - 1
        size = len(counts[level])
        feature[level][at[split]], cut[level][at[split]] = chosen[split], bins[split]
        child[level][at[split]] = first + size + 2 * np.arange(split.sum())
        splits.append(first + at[split])
        both = np.empty((2 * split.sum(), k))
        both[0::2] = lower[split]
        both[1::2] = counts[level][at[split]] - lower[split]
        below = np.empty(len(both), np.int64)
        below[0::2], below[1::2] = 2 * paths[split], 2 * paths[split] + 1
        for parts, kind in ((feature, np.int16), (cut, np.uint8), (child, np.int32)):
            parts.append(np.zeros(len(both), kind))
        counts.append(both)
        kept = split[place]
        rows, place = rows[kept], place[kept]
        side = 2 * number[place] + (x[rows, chosen[place]] > bins[place])
        goes_on = open_nodes(both)
        at, paths = np.flatnonzero(goes_on), below[goes_on]
        kept = goes_on[side]
        rows, place = rows[kept], (np.cumsum(goes_on) - 1)[side[kept]]
        first, level = first + size, level + 1
    nodes = Nodes(*(np.concatenate(parts) for parts in (feature, cut, child)))
    values = np.concatenate(counts) * plan.weights
    values /= np.maximum(values.sum(1, keepdims=True), _EPS)
    decided = values.argmax(1)
    for split in reversed(splits):
        left = nodes.child[split]
        same = (nodes.child[left] == 0) & (nodes.child[left + 1] == 0) & (decided[left] == decided[left + 1])
        nodes.child[split[same]] = 0
    # Nodes under a merged leaf go; those left keep their order.
    used = np.zeros(len(values), bool)
    used[0] = True
    for split in splits:
        left = nodes.child[split[used[split] & (nodes.child[split] > 0)]]
        used[left] = used[left + 1] = True
    number = np.cumsum(used) - 1
    left = nodes.child[used]
    return Nodes(nodes.feature[used], nodes.cut[used], np.where(left > 0, number[left], 0).astype(np.int32)), values[used]


class Sample:
    """A task's share of the different rows."""

    def __init__(self, batches: Iterator[pa.RecordBatch], width: int):
        parts = list(batches)
        column = lambda i, kind: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts] or [np.zeros(0, kind)])
        self.x = np.frombuffer(b"".join(v for b in parts for v in b.column(0).to_pylist()), np.uint8).reshape(-1, width)
        self.y, n, self.keys = column(1, np.int32), column(2, np.int64), column(3, np.int64).view(np.uint64)
        means, which = np.unique(n, return_inverse=True)
        places = np.split(np.argsort(which, kind="stable"), np.cumsum(np.bincount(which, minlength=len(means)))[:-1]) if len(n) else []
        self.groups = [(low, rows, points) for mean, rows in zip(means.tolist(), places) for low, points in [poisson_cut_points(mean)]]

    def of(self, tree: int, nodes: Nodes, slots: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of a tree's sample at ``slots`` (ascending): their places, how often they count and the places of their slots."""
        n = drawn(self.keys, self.groups, plan.seed, tree)
        rows = np.flatnonzero(n)
        at = nodes.reached(self.x[rows])
        place = np.searchsorted(slots, at)
        kept = slots[np.minimum(place, len(slots) - 1)] == at
        return rows[kept], n[rows[kept]], place[kept]


def _sent(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}
    named = [field.split(" ") for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], [name for name, _ in named])


def _node_sums(batches: Iterator[pa.RecordBatch], tops: list[Top], todo: dict[int, np.ndarray], plan: Plan) -> Iterator[pa.RecordBatch]:
    """Per node the samples' rows by tried feature, bin and class, and the number of different rows."""
    sample, k = Sample(batches, plan.width), plan.classes
    for tree, slots in todo.items():
        rows, n, place = sample.of(tree, tops[tree].nodes(), slots, plan)
        tried = tried_features(tops[tree].path[slots], tree, plan)
        sums = np.empty((len(slots), plan.tried, BINS, k + 1))
        for s in range(plan.tried):
            cell = (place * BINS + sample.x[rows, tried[place, s]]) * (k + 1)
            size = len(slots) * BINS * (k + 1)
            found = np.bincount(cell + sample.y[rows], weights=n, minlength=size) + np.bincount(cell + k, minlength=size)
            sums[:, s] = found.reshape(len(slots), BINS, k + 1)
        present = np.unique(place)
        yield _sent([[tree] * len(present), slots[present].tolist(), [sums[p].tobytes() for p in present]], _SUMS)


def _node_splits(batches: Iterator[pa.RecordBatch], tops: list[Top], plan: Plan) -> Iterator[pa.RecordBatch]:
    """The best split of every node from the sums of all tasks; feature -1: none."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for tree, slot, sums in zip(*(c.to_pylist() for c in batch.columns)):
            values = np.frombuffer(sums)
            total[tree, slot] = total[tree, slot] + values if (tree, slot) in total else values
    out: list[list] = [[] for _ in range(6)]
    for (tree, slot), values in total.items():
        sums = values.reshape(plan.tried, BINS, plan.classes + 1)
        gain, cut, lower = best_cuts(sums, plan)
        s = int(gain.argmax())
        feature = int(tried_features(tops[tree].path[[slot]], tree, plan)[0, s]) if gain[s] > _EPS else -1
        found = [tree, slot, feature, int(cut[s]), lower[s].tolist(), (sums[s].sum(0) - lower[s]).tolist()]
        for column, value in zip(out, found):
            column.append(value)
    yield _sent(out, _SPLITS)


def _node_rows(batches: Iterator[pa.RecordBatch], tops: list[Top], todo: dict[int, np.ndarray], plan: Plan) -> Iterator[pa.RecordBatch]:
    """The samples' rows by node, packed."""
    sample = Sample(batches, plan.width)
    for tree, slots in todo.items():
        rows, n, place = sample.of(tree, tops[tree].nodes(), slots, plan)
        order = np.argsort(place, kind="stable")
        rows, n, place = rows[order], n[order], place[order]
        present, starts = np.unique(place, return_index=True)
        packed = [(sample.x[r].tobytes(), sample.y[r].astype(np.int32).tobytes(), m.tobytes()) for r, m in zip(np.split(rows, starts[1:]), np.split(n, starts[1:]))]
        if len(present):
            yield _sent([[tree] * len(present), slots[present].tolist(), *map(list, zip(*packed))], _ROWS)


def _grown(table: pa.Table, tops: list[Top], plan: Plan) -> pa.Table:
    tree, slot = table.column(0)[0].as_py(), table.column(1)[0].as_py()
    x, y, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("x", np.uint8), ("y", np.int32), ("n", np.float64)))
    top = tops[tree]
    nodes, values = grow(x.reshape(-1, plan.width), y, n, tree, int(top.path[slot]), int(top.depth[slot]), plan)
    packed = [a.tobytes() for a in (nodes.feature, nodes.cut, nodes.child, values.astype(np.float32))]
    return pa.Table.from_batches([_sent([[tree], [slot], [len(values)], *([p] for p in packed)], _NODES)])


@dataclass
class Top:
    """The large nodes of a tree and those right below them, one row each; ``state`` is open, below (grown by one task) or leaf."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    path: np.ndarray
    depth: np.ndarray
    state: np.ndarray
    value: np.ndarray

    @classmethod
    def root(cls, state: int, classes: int) -> Top:
        one = lambda kind, v=0: np.array([v], kind)
        return cls(one(np.int16), one(np.uint8), one(np.int32), one(np.int64, 1), one(np.int32), one(np.int8, state), np.zeros((1, classes)))

    def nodes(self) -> Nodes:
        return Nodes(self.feature, self.cut, self.child)

    def split(self, found: list, plan: Plan) -> None:
        """Gives the open slots of ``found`` their children, or makes them leaves."""
        self.state[self.state == OPEN] = LEAF
        for r in found:
            whole = (np.array(r["lower"]) + r["upper"])[:-1] * plan.weights
            self.value[r["slot"]] = whole / max(whole.sum(), _EPS)
        found = [r for r in found if r["feature"] >= 0]
        if not found:
            return
        slots = np.array([r["slot"] for r in found])
        sides = np.array([side for r in found for side in (r["lower"], r["upper"])])
        counts, rows = sides[:, :-1], sides[:, -1]
        self.feature[slots], self.cut[slots] = [r["feature"] for r in found], [r["cut"] for r in found]
        self.child[slots] = len(self.child) + 2 * np.arange(len(slots))
        depth = np.repeat(self.depth[slots] + 1, 2)
        path = np.repeat(2 * self.path[slots], 2) + np.tile([0, 1], len(slots))
        state = np.where(~open_nodes(counts) | (depth >= plan.depth), LEAF, np.where(rows > NODE_ROWS, OPEN, BELOW))
        weighted = counts * plan.weights
        new = Top(
            np.zeros(len(sides), np.int16), np.zeros(len(sides), np.uint8), np.zeros(len(sides), np.int32), path, depth, state,
            weighted / np.maximum(weighted.sum(1, keepdims=True), _EPS),
        )
        for name in self.__dataclass_fields__:
            setattr(self, name, np.concatenate([getattr(self, name), getattr(new, name)]))

    def merge(self, leaves: np.ndarray) -> None:
        """Two leaves of one decision become one, from the lowest up; ``leaves`` are grown slots of one node."""
        leaf = (self.state == LEAF) & (self.child == 0)
        leaf[leaves] = True
        decided = self.value.argmax(1)
        for slot in np.flatnonzero(self.child)[::-1]:
            left = self.child[slot]
            if leaf[left] and leaf[left + 1] and decided[left] == decided[left + 1]:
                self.child[slot], self.state[slot], leaf[slot] = 0, LEAF, True


OPEN, BELOW, LEAF = 0, 1, 2


@dataclass
class GrownForest:
    """A fitted forest: the tops of its trees, and a table with what is below them. Adds ``probability`` and ``_prediction``."""

    statement: str
    names: list[str]
    cuts: list[np.ndarray]
    tops: list[Top]
    classes: int
    path: str

    def transform(self, df: DataFrame) -> DataFrame:
        wide = SQLTransformer(statement=self.statement).transform(df)
        wide = wide.withColumn("_x", F.array(*self.names)).drop(*self.names)
        if not df.isStreaming:
            # A small file is one share, however many rows it has.
            wide = wide.repartition(df.sparkSession.sparkContext.defaultParallelism)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema if f.name != "_x") + ", _p array<double>"
        forest = self

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= SCORE_ROWS:
                    yield from forest.scored(held)
                    held = []
            if held:
                yield from forest.scored(held)

        best = F.array_position("_p", F.array_max("_p")) - 1
        out = wide.mapInArrow(score, schema)
        return out.withColumns({"probability": array_to_vector("_p"), "_prediction": best.cast("double")}).drop("_p")

    def scored(self, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.concatenate([binned(b.column("_x"), self.cuts) for b in batches])
        shares, start = self.shares(x), 0
        for batch in batches:
            part = shares[start : start + batch.num_rows]
            start += batch.num_rows
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * self.classes), pa.array(part.ravel()))
            kept = batch.drop_columns(["_x"])
            yield pa.RecordBatch.from_arrays([*kept.columns, flat], names=[*kept.schema.names, "_p"])

    def shares(self, x: np.ndarray) -> np.ndarray:
        """The trees' mean shares of the classes. What is below the tops is read as it is needed, some nodes at a time."""
        total = np.zeros((len(x), self.classes))
        for top in self.tops:
            at = top.nodes().reached(x)
            done = np.flatnonzero(top.state[at] == LEAF)
            total[done] += top.value[at[done]]
        system, plain = located(self.path)
        files = [f.path for f in system.get_file_info(fs.FileSelector(plain)) if f.path.endswith(".parquet")]
        for file in sorted(files):
            tree, order, at = -1, np.zeros(0, np.int64), np.zeros(0, np.int32)
            with system.open_input_file(file) as source:
                for batch in pq.ParquetFile(source).iter_batches(batch_size=8):
                    for row in batch.to_pylist():
                        if row["tree"] != tree:
                            tree = row["tree"]
                            at = self.tops[tree].nodes().reached(x)
                            order = np.argsort(at, kind="stable")
                            at = at[order]
                        i, j = np.searchsorted(at, [row["slot"], row["slot"] + 1])
                        if i < j and self.tops[tree].state[row["slot"]] == BELOW:
                            kinds = zip(("feature", "cut", "child"), (np.int16, np.uint8, np.int32))
                            nodes = Nodes(*(np.frombuffer(row[name], kind) for name, kind in kinds))
                            value = np.frombuffer(row["value"], np.float32).reshape(-1, self.classes)
                            total[order[i:j]] += value[nodes.reached(x[order[i:j]])]
        return total / len(self.tops)

    def stored(self, spark: SparkSession, path: str) -> dict:
        """Writes the table under ``path``; returns the rest as plain values."""
        spark.read.schema(_NODES).parquet(self.path).repartition("tree").sortWithinPartitions("tree", "slot").write.mode("overwrite").parquet(path)
        tops = [{name: getattr(t, name).tolist() for name in t.__dataclass_fields__} for t in self.tops]
        return {"statement": self.statement, "names": self.names, "cuts": [c.tolist() for c in self.cuts], "tops": tops, "classes": self.classes}

    @classmethod
    def loaded(cls, about: dict, path: str) -> GrownForest:
        kinds = dict(zip(Top.__dataclass_fields__, (np.int16, np.uint8, np.int32, np.int64, np.int32, np.int8, np.float64)))
        tops = [Top(**{name: np.array(t[name], kind) for name, kind in kinds.items()}) for t in about["tops"]]
        return cls(about["statement"], about["names"], [np.array(c, float) for c in about["cuts"]], tops, about["classes"], path)


def cut_values(rows: DataFrame, names: Sequence[str]) -> list[np.ndarray]:
    """Per feature up to 31 values that part its bins: between all values if they are few, else quantiles."""
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    parts = rows.agg(*[a for c in names for a in (F.approx_count_distinct(c), F.percentile_approx(c, shares, 10000))]).first()
    found = {c: np.unique(np.array(parts[2 * i + 1] or [], float)) for i, c in enumerate(names)}
    few = [c for i, c in enumerate(names) if parts[2 * i] <= 2 * BINS]
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in few]))
        listed: dict[str, list[float]] = {}
        for r in rows.select(pairs.alias("p")).select("p.*").distinct().collect():
            listed.setdefault(r["name"], []).append(r["value"])
        for c, values in listed.items():
            if len(values) <= BINS:
                ordered = np.sort(np.array(values, float))
                found[c] = (ordered[1:] + ordered[:-1]) / 2
    return [found[c] for c in names]


def binned(column: pa.Array, cuts: list[np.ndarray]) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
    return np.column_stack([np.searchsorted(c, x[:, i], side="left").astype(np.uint8) for i, c in enumerate(cuts)])


def _binned_rows(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = binned(batch.column(0), cuts)
        packed = pa.array([r.tobytes() for r in x], pa.binary())
        yield pa.RecordBatch.from_arrays([packed, batch.column(1)], ["x", "y"])


def grow_forest(
    rows: DataFrame, projection: SQLTransformer, names: Sequence[str], weights: Sequence[float], trees: int, depth: int, seed: int, least: int = 1
) -> GrownForest:
    """A forest on ``rows`` with ``_y`` (class number); ``projection`` adds the feature columns ``names``.

    The driver holds the large nodes only. ``depth`` is at most 60.
    """
    spark, cores = rows.sparkSession, rows.sparkSession.sparkContext.defaultParallelism
    plan = Plan(trees, depth, least, seed, len(names), np.array(weights, float))
    wide = projection.transform(rows)
    cuts = cut_values(wide, names)
    seen = wide.select(F.array(*names).alias("x"), F.col("_y").cast("int").alias("y")).repartition(cores)
    equal = seen.mapInArrow(lambda b: _binned_rows(b, cuts), "x binary, y int").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    sample = saved_table(equal.withColumn("key", F.xxhash64("x", "y")), "sample")
    n = sample.count()
    sample = sample.repartition(-(-max(n, 1) // (SHARE_ROWS * cores)) * cores)
    tops = [Top.root(OPEN if n > NODE_ROWS else BELOW, plan.classes) for _ in range(trees)]

    def slots_of(state: int) -> dict[int, np.ndarray]:
        return {t: s for t, top in enumerate(tops) if len(s := np.flatnonzero((top.state == state) & (top.child == 0)))}

    while todo := slots_of(OPEN):
        sums = sample.mapInArrow(lambda b, o=todo: _node_sums(b, tops, o, plan), _SUMS)
        splits: dict[int, list] = {}
        for r in sums.repartition("tree", "slot").mapInArrow(lambda b: _node_splits(b, tops, plan), _SPLITS).collect():
            splits.setdefault(r["tree"], []).append(r)
        for t in todo:
            tops[t].split(sorted(splits.get(t, []), key=lambda r: r["slot"]), plan)
    path, todo = scratch_path(spark, "forest"), slots_of(BELOW)
    shares = max(1, min(max(4 * cores, n * trees // (16 * SHARE_ROWS)), sum(map(len, todo.values()))))
    packed = sample.mapInArrow(lambda b: _node_rows(b, tops, todo, plan), _ROWS).repartition(shares, "tree", "slot")
    grown = packed.groupBy("tree", "slot").applyInArrow(lambda t: _grown(t, tops, plan), _NODES)
    grown.repartition(min(trees, cores), "tree").sortWithinPartitions("tree", "slot").write.parquet(path)
    alone: dict[int, list[int]] = {}
    for r in spark.read.schema(_NODES).parquet(path).where("size = 1").select("tree", "slot").collect():
        alone.setdefault(r["tree"], []).append(r["slot"])
    for t, top in enumerate(tops):
        top.merge(np.array(alone.get(t, []), np.int64))
    return GrownForest(projection.getStatement(), list(names), cuts, tops, plan.classes, path)
