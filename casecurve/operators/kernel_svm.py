"""Support vector machines with an RBF kernel, through landmarks.

A fixed number of training rows, the landmarks, spans the kernel: a row's features are its kernel values to them,
turned so that their inner products are the kernel's own wherever a landmark is involved. With all rows as
landmarks this is the exact machine. The weights minimise half their squares plus the class-weighted
hinge losses, the intercept is free. The hinge's corner is rounded over a width that shrinks from 1 to a
thousandth, and each Newton step is one job: tasks send sums of loss, gradient and Hessian, for all classes
together, and never rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LANDMARKS = 256
WIDTHS = (1.0, 0.1, 0.01, 0.001)
_STEPS = 40
_TOLERANCE = 1e-9
# Shares of a Newton step that are tried, 0 among them: a model never gets worse.
_LENGTHS = np.array([0.0, *0.5 ** np.arange(12)])
_FLAT = 1e-10
_CHUNK = 4096
_SUMS = "model int, chunk int, sums array<double>"


def rbf(x: np.ndarray, landmarks: np.ndarray, gamma: float) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (landmarks * landmarks).sum(1) - 2 * x @ landmarks.T
    return np.exp(-gamma * np.maximum(square, 0.0))


@dataclass
class Landmarks:
    """The kernel's features: ``turn`` makes rbf(L, L) times itself the identity on what the landmarks span."""

    points: np.ndarray
    gamma: float
    turn: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, gamma: float) -> Landmarks:
        values, axes = np.linalg.eigh(rbf(points, points, gamma))
        kept = values > _FLAT * values.max(initial=0.0)
        return cls(points, gamma, axes[:, kept] / np.sqrt(values[kept]))

    def features(self, x: np.ndarray) -> np.ndarray:
        """A column per kept direction, and ones for the intercept."""
        return np.column_stack([rbf(x, self.points, self.gamma) @ self.turn, np.ones(len(x))])


def rounded_hinge(margin: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hinge max(0, 1 - margin) with a parabola for its corner: value, first and second derivative."""
    gap = 1.0 - margin
    corner = np.abs(gap) < width
    value = np.where(corner, (gap + width) ** 2 / (4 * width), np.maximum(gap, 0.0))
    slope = np.where(corner, -(gap + width) / (2 * width), np.where(gap > 0, -1.0, 0.0))
    return value, slope, np.where(corner, 1.0 / (2 * width), 0.0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _read(batches: Iterator[pa.RecordBatch], kernel: Landmarks, costs: np.ndarray, models: list[int]):
    """Features, and per model the signs and costs of a batch's rows: one class against the rest."""
    for batch in batches:
        x = kernel.features(_matrix(batch.column(0), kernel.points.shape[1]))
        y = batch.column(1).to_numpy()
        for c in models:
            yield c, x, np.where(y == c, 1.0, -1.0), np.where(y == c, costs[c, 0], costs[c, 1])


def _sent(total: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    keys = [pa.array(k, pa.int32()) for k in zip(*total)] or [pa.array([], pa.int32())] * 2
    return pa.RecordBatch.from_arrays([*keys, pa.array([s.tolist() for s in total.values()], pa.list_(pa.float64()))], ["model", "chunk", "sums"])


def _in_chunks(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sums in lists of fixed length, so that adding up is spread too."""
    chunks = {(c, i // _CHUNK): s[i : i + _CHUNK] for c, s in total.items() for i in range(0, len(s), _CHUNK)}
    yield _sent(chunks)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for model, chunk, sums in zip(*(c.to_pylist() for c in batch.columns)):
            key = model, chunk
            total[key] = total[key] + np.array(sums) if key in total else np.array(sums)
    yield _sent(total)


def _slopes(batches: Iterator[pa.RecordBatch], kernel: Landmarks, at: dict[int, np.ndarray], costs: np.ndarray, width: float) -> Iterator[pa.RecordBatch]:
    """Per model the gradient and Hessian of the rounded losses of a task's rows."""
    total: dict[int, np.ndarray] = {}
    for c, x, sign, cost in _read(batches, kernel, costs, list(at)):
        _, slope, curve = rounded_hinge(sign * (x @ at[c]), width)
        near = curve > 0
        hessian = x[near].T @ (x[near] * (cost * curve)[near, None])
        sums = np.concatenate([x.T @ (cost * slope * sign), hessian[np.triu_indices(x.shape[1])]])
        total[c] = total[c] + sums if c in total else sums
    yield from _in_chunks(total)


def _losses(batches: Iterator[pa.RecordBatch], kernel: Landmarks, tried: dict[int, np.ndarray], costs: np.ndarray, width: float) -> Iterator[pa.RecordBatch]:
    """Per model the losses of a task's rows at several weights."""
    total: dict[int, np.ndarray] = {}
    for c, x, sign, cost in _read(batches, kernel, costs, list(tried)):
        sums = cost @ rounded_hinge(sign[:, None] * (x @ tried[c].T), width)[0]
        total[c] = total[c] + sums if c in total else sums
    yield from _in_chunks(total)


def _added(found: DataFrame, models: Iterable[int], size: int) -> dict[int, np.ndarray]:
    values = {c: np.zeros(size) for c in models}
    for r in found.repartition("model", "chunk").mapInArrow(_together, _SUMS).collect():
        start = r["chunk"] * _CHUNK
        values[r["model"]][start : start + len(r["sums"])] = r["sums"]
    return values


def fit_weights(design: DataFrame, kernel: Landmarks, n_models: int, costs: np.ndarray) -> np.ndarray:
    """``[class, weight]`` for ``design`` (``x`` array, ``y`` int), the intercept last.

    ``costs[c]`` is the cost of a row of class c and of one of the rest. A Newton step of all models is two jobs:
    the sums, then the losses at steps of several lengths, of which each model takes its best.
    """
    size = kernel.turn.shape[1] + 1
    weights = np.zeros((n_models, size))
    ridge = np.append(np.ones(size - 1), 0.0)
    for width in WIDTHS:
        todo = list(range(n_models))
        for _ in range(_STEPS):
            if not todo:
                break
            at = {c: weights[c] for c in todo}
            sums = design.mapInArrow(lambda b, w=at, d=width: _slopes(b, kernel, w, costs, d), _SUMS)
            values, tried, promised = _added(sums, todo, size + size * (size + 1) // 2), {}, {}
            for c in todo:
                slope = values[c][:size] + ridge * weights[c]
                hessian = np.zeros((size, size))
                hessian[np.triu_indices(size)] = values[c][size:]
                hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge)
                # Without any row near the margin nothing holds the intercept: a short step for it.
                hessian[-1, -1] += 1e-6
                step = np.linalg.solve(hessian, slope)
                step /= max(1.0, np.abs(step).max() / 100.0)
                promised[c] = slope @ step
                tried[c] = weights[c] - _LENGTHS[:, None] * step
            found = design.mapInArrow(lambda b, w=tried, d=width: _losses(b, kernel, w, costs, d), _SUMS)
            losses = _added(found, todo, len(_LENGTHS))
            left = []
            for c in todo:
                whole = losses[c] + 0.5 * np.square(tried[c]) @ ridge
                best = int(whole.argmin())
                weights[c] = tried[c][best]
                if _LENGTHS[best] > 0 and promised[c] > _TOLERANCE * (1.0 + whole[best]):
                    left.append(c)
            todo = left
    return weights


def decisions(kernel: Landmarks, weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A column per class; of two classes one is the other's negative."""
    values = kernel.features(x) @ weights.T
    return np.column_stack([values[:, 0], -values[:, 0]]) if len(weights) == 1 else values


@dataclass
class KernelMachine:
    """A fitted machine; adds ``rawPrediction`` (a value per class) and ``_prediction`` like a fitted pipeline."""

    projections: list[SQLTransformer]
    names: list[str]
    kernel: Landmarks
    weights: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        for p in self.projections:
            df = p.transform(df)
        wide = df.withColumn("_x", F.array(*self.names)).drop(*self.names)
        kernel, weights, width = self.kernel, self.weights, len(self.names)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema if f.name != "_x") + ", _raw array<double>"

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = decisions(kernel, weights, _matrix(batch.column("_x"), width))
                kept = batch.drop_columns(["_x"])
                column = pa.array(raw.tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, column], names=[*kept.schema.names, "_raw"])

        best = F.array_position("_raw", F.array_max("_raw")) - 1
        return wide.mapInArrow(score, schema).withColumns({"rawPrediction": array_to_vector("_raw"), "_prediction": best.cast("double")}).drop("_raw")


def chosen_landmarks(design: DataFrame, n: int, wanted: int) -> np.ndarray:
    """``wanted`` of the ``n`` rows by the hash of their features, so that every run takes the same; equal rows count once."""
    points = design.select("x").distinct()
    share = 1.0 if n <= 2 * wanted else min(1.0, (1.5 * wanted + 100) / n)
    hashed = points.withColumn("h", F.pmod(F.xxhash64("x"), F.lit(1 << 30)))
    found = hashed.where(F.col("h") <= int(share * (1 << 30))).collect()
    if len(found) < wanted and share < 1.0:
        found = hashed.collect() if n <= 100 * wanted else found
    found.sort(key=lambda r: (r.h, r.x))
    return np.array([r.x for r in found[:wanted]], dtype=float)


def fit_kernel_machine(
    rows: DataFrame, projections: list[SQLTransformer], names: Sequence[str], counts: dict[str, int], cost: float = 1.0, landmarks: int = LANDMARKS
) -> KernelMachine:
    """A machine on ``rows`` with ``_y`` (class number); ``projections`` add the feature columns ``names``.

    gamma is 1 / (features * variance of all features together). The cost of a row is ``cost``, weighted so that
    every class has the same total. ``landmarks`` bounds what the driver and each task hold: their features
    and, for each class, a square of their number.
    """
    for p in projections:
        rows = p.transform(rows)
    parts = rows.agg(*[f(n) for n in names for f in (F.avg, F.var_pop)]).first()
    centres, spreads = np.array(parts[::2], dtype=float), np.array(parts[1::2], dtype=float)
    gamma = 1.0 / (len(names) * (float(spreads.mean() + centres.var()) or 1.0))
    design = rows.select(F.array(*names).alias("x"), F.col("_y").cast("int").alias("y"))
    total, k = sum(counts.values()), len(counts)
    kernel = Landmarks.of(chosen_landmarks(design, total, landmarks), gamma)
    balanced = [cost * total / (k * n) for n in counts.values()]
    n_models = 1 if k == 2 else k
    if k == 2:
        costs = np.array([balanced])
    else:
        # One class against the rest: the rest as a class of its own.
        costs = np.array([[cost * total / (2 * n), cost * total / (2 * max(1, total - n))] for n in counts.values()])
    return KernelMachine(projections, list(names), kernel, fit_weights(design, kernel, n_models, costs))
