"""Two-class logistic regression for all folds of a cross-validation together.

Every Newton step is one job: each task adds up, for every fold's model, the loss, the gradient and the Hessian of
the rows that the fold does not hold out, and sends one row of sums per model. Rows are read where
they lie and are never copied per fold. The driver solves one small system per model. A step that raises a
model's loss is halved for that model; the others go on.

Preprocessing is that of ``train_classifier``, per training part: median and mode imputation, (x - mean) /
population std, 1/0 columns per category with the first of two dropped, balanced class weights. Its
statistics come from counts and moments per fold, merged for each model.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.numbers import lenient_double
from casecurve.operators.features import MAX_CATEGORIES, kept_categories
from casecurve.operators.quantiles import summarise_values
from casecurve.session import saved_table

PASSES = 50
TOLERANCE = 1e-9
# The model of all rows.
ALL = -1


@dataclass
class Preprocessing:
    """Statistics of one model's training rows. ``kept[i]`` marks the categories of column i that have a weight."""

    medians: np.ndarray
    means: np.ndarray
    stds: np.ndarray
    modes: list[int]
    kept: list[np.ndarray]
    weights: np.ndarray

    def features(self, numbers: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Scaled numbers, a column per category, and ones for the intercept."""
        filled = np.where(np.isnan(numbers), self.medians, numbers)
        parts = [(filled - self.means) / self.stds]
        for i, kept in enumerate(self.kept):
            code = np.where(codes[:, i] < 0, self.modes[i], codes[:, i])
            parts.append((code[:, None] == np.arange(len(kept))) * kept)
        return np.column_stack([*parts, np.ones(len(numbers))])


@dataclass
class FoldModels:
    """The fitted models by the fold they hold out (``ALL``: none). Coefficients end with the intercept."""

    classes: list[str]
    numeric: list[str]
    categorical: list[str]
    categories: list[list[str]]
    preprocessing: dict[int, Preprocessing]
    coefficients: dict[int, np.ndarray]
    passes: int

    @property
    def terms(self) -> list[str]:
        named = [f"{c}={v}" for c, values in zip(self.categorical, self.categories) for v in values]
        return [*self.numeric, *named, "intercept"]


def _moments(rows: DataFrame, numeric: Sequence[str]) -> dict[int, list[tuple[int, float, float]]]:
    """Per fold and column: present values, their mean and population variance; one job."""
    number = {c: lenient_double(F.col(c)) for c in numeric}
    columns = [f(number[c]).alias(f"{name}_{i}") for i, c in enumerate(numeric) for name, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))]
    found = rows.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"), *columns).collect()
    return {r["fold"]: [(r[f"n_{i}"], r[f"m_{i}"] or 0.0, r[f"v_{i}"] or 0.0) for i in range(len(numeric))] for r in found}


def _counts(rows: DataFrame, columns: Sequence[str], most: int) -> dict[tuple[str, str], dict[int, int]]:
    """Rows per fold of every value of every column; more than ``most`` values of one are an error."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = rows.select("fold", F.explode(cells).alias("c")).where("c.value IS NOT NULL").groupBy("c.column", "c.value")
    # A row per value with its folds, so that the bound holds for what is collected.
    per_fold = rows.select("fold", F.explode(cells).alias("c")).where("c.value IS NOT NULL").groupBy("c.column", "c.value", "fold")
    seen: dict[str, int] = {}
    for r in counted.agg(F.lit(1)).select("column").limit(len(columns) * most + 1).collect():
        seen[r["column"]] = seen.get(r["column"], 0) + 1
    for c, n in seen.items():
        if n > most:
            raise ValueError(f"{c} has more than {most} values")
    found: dict[tuple[str, str], dict[int, int]] = {}
    for r in per_fold.agg(F.count(F.lit(1)).alias("n")).collect():
        found.setdefault((r["column"], r["value"]), {})[r["fold"]] = r["n"]
    return found


def _pooled(groups: Iterable[tuple[int, float, float]]) -> tuple[float, float]:
    """Mean and population variance of groups of (count, mean, variance)."""
    groups = [g for g in groups if g[0]]
    n = sum(g[0] for g in groups)
    if not n:
        return 0.0, 0.0
    mean = sum(g[0] * g[1] for g in groups) / n
    return mean, sum(g[0] * (g[2] + (g[1] - mean) ** 2) for g in groups) / n


def _preprocessing(
    rows: DataFrame, folds: list[int], label: str, numeric: Sequence[str], categorical: Sequence[str], most: int
) -> tuple[list[str], list[list[str]], dict[int, Preprocessing]]:
    counts = _counts(rows, [label, *categorical], most)
    classes = sorted(v for c, v in counts if c == label)
    if len(classes) != 2:
        raise ValueError(f"two classes are needed, {label} has {len(classes)}")
    categories = [sorted(v for c, v in counts if c == column) for column in categorical]
    per_fold = _moments(rows, numeric) if numeric else {}
    models = [ALL, *folds]
    # Every row counts for each model that does not hold its fold out; only sketches and counts are shuffled.
    others = F.filter(F.array(*[F.lit(m) for m in models]), lambda m: m != F.col("fold"))
    middle = {}
    if numeric:
        summary = summarise_values(rows.withColumn("model", F.explode(others)), numeric, (0.5,), ["model"])
        middle = {(r["model"], r["column"]): r["quantiles"][0] for r in summary.collect()}

    def kept_rows(column: str, value: str, model: int) -> int:
        return sum(n for fold, n in counts.get((column, value), {}).items() if fold != model)

    out = {}
    for m in models:
        n_class = [kept_rows(label, c, m) for c in classes]
        total = sum(n_class)
        medians = np.array([middle.get((m, c), 0.0) for c in numeric], dtype=float)
        pooled = []
        for i in range(len(numeric)):
            groups = [cells[i] for fold, cells in per_fold.items() if fold != m]
            pooled.append(_pooled([*groups, (total - sum(g[0] for g in groups), medians[i], 0.0)]))
        modes, kept = [], []
        for column, values in zip(categorical, categories):
            here = {v: kept_rows(column, v, m) for v in values}
            present = [v for v in values if here[v]]
            usual = max(present, key=here.get) if present else None
            modes.append(values.index(usual) if usual is not None else -1)
            used = set(kept_categories(present))
            kept.append(np.array([float(v in used) for v in values]))
        weights = np.array([total / (2.0 * n) if n else 0.0 for n in n_class])
        stds = np.array([v**0.5 or 1.0 for _, v in pooled], dtype=float)
        out[m] = Preprocessing(medians, np.array([p[0] for p in pooled], dtype=float), stds, modes, kept, weights)
    return classes, categories, out


def _sums(batches: Iterator[pa.RecordBatch], preprocessing: dict[int, Preprocessing], at: dict[int, np.ndarray], n_numeric: int) -> Iterator[pa.RecordBatch]:
    """Per model the weighted loss, gradient and Hessian of all batches of a task, as one list."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        fold, y = columns[0], columns[1]
        numbers = np.column_stack([np.zeros((len(y), 0)), *[np.asarray(c, dtype=float) for c in columns[2 : 2 + n_numeric]]])
        codes = np.column_stack([np.zeros((len(y), 0), int), *columns[2 + n_numeric :]])
        for m, beta in at.items():
            rows = fold != m
            x, target = preprocessing[m].features(numbers[rows], codes[rows]), y[rows]
            weight = preprocessing[m].weights[target]
            eta = x @ beta
            p = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            loss = float(weight @ (np.logaddexp(0.0, eta) - target * eta))
            slope = x.T @ (weight * (p - target))
            curve = x.T @ (x * (weight * p * (1 - p))[:, None])
            sums = np.concatenate([[loss], slope, curve[np.triu_indices(len(beta))]])
            total[m] = total[m] + sums if m in total else sums
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([s.tolist() for s in total.values()], pa.list_(pa.float64()))], ["model", "sums"]
    )


def fit_logistic_folds(
    folded: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str] = (),
    penalty: float = 1.0,
    max_categories: int = MAX_CATEGORIES,
    saved: bool = False,
) -> FoldModels:
    """A model per value of ``fold`` that does not see the fold's rows, and one of all rows.

    ``penalty`` is the weight of half the squared coefficients beside the summed loss; the intercept is free. The
    first class in order is 0, the second 1. Rows without a label or fold are left out. A model whose
    training rows are all of one class always gives that class. Labels of other than two classes, or more
    than ``max_categories`` values, raise an error. The rows are written once, unless they are ``saved``.
    """
    rows = folded.select("fold", label, *numeric, *categorical).where(F.col(label).isNotNull() & F.col("fold").isNotNull())
    rows = rows.withColumn("fold", F.col("fold").cast("int"))
    rows = rows if saved else saved_table(rows, "folds")
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())
    classes, categories, preprocessing = _preprocessing(rows, folds, label, numeric, categorical, max_categories)
    cells = [F.array_position(F.array(*[F.lit(v) for v in values]), F.col(c).cast("string")) for c, values in zip(categorical, categories)]
    # Codes from 0; -1 for a missing value, as each present one is among the categories.
    codes = [(F.coalesce(cell, F.lit(0)) - 1).cast("int").alias(f"c{i}") for i, cell in enumerate(cells)]
    y = (F.col(label).cast("string") == classes[1]).cast("int").alias("y")
    design = rows.select("fold", y, *[lenient_double(F.col(c)).alias(f"x{i}") for i, c in enumerate(numeric)], *codes)

    width = len(numeric) + sum(map(len, categories)) + 1
    ridge = np.full(width, float(penalty))
    ridge[-1] = 0.0
    at = {m: np.zeros(width) for m in preprocessing}
    accepted: dict[int, tuple[float, np.ndarray]] = {}
    done: dict[int, np.ndarray] = {}
    for m, p in preprocessing.items():
        if (p.weights == 0).any():
            done[m] = np.append(np.zeros(width - 1), 1e3 if p.weights[1] else -1e3)
    passes = 0
    while len(done) < len(at) and passes < PASSES:
        passes += 1
        current = {m: b for m, b in at.items() if m not in done}
        sums = design.mapInArrow(lambda b, c=current: _sums(b, preprocessing, c, len(numeric)), "model int, sums array<double>")
        added = sums.select("model", F.posexplode("sums").alias("i", "s")).groupBy("model", "i").agg(F.sum("s").alias("s"))
        values = {m: np.zeros(1 + width + width * (width + 1) // 2) for m in current}
        for r in added.collect():
            values[r["model"]][r["i"]] = r["s"]
        for m, beta in current.items():
            loss = values[m][0] + 0.5 * ridge @ beta**2
            if m in accepted and loss > accepted[m][0] + 1e-12 * abs(loss):
                at[m] = (accepted[m][1] + beta) / 2
                if np.abs(at[m] - accepted[m][1]).max() <= TOLERANCE:
                    done[m] = accepted[m][1]
                continue
            accepted[m] = loss, beta
            slope = values[m][1 : 1 + width] + ridge * beta
            curve = np.zeros((width, width))
            curve[np.triu_indices(width)] = values[m][1 + width :]
            curve = curve + np.triu(curve, 1).T + np.diag(ridge + 1e-12)
            step = np.linalg.solve(curve, slope)
            at[m] = beta - step
            if np.abs(step).max() <= TOLERANCE * (1.0 + np.abs(beta).max()):
                done[m] = at[m]
    coefficients = {m: done.get(m, accepted[m][1] if m in accepted else at[m]) for m in at}
    return FoldModels(classes, list(numeric), list(categorical), categories, preprocessing, coefficients, passes)


def linear_score(fitted: FoldModels, model: Column) -> Column:
    """The log-odds of the second class under the model that ``model`` names, as a plain expression.

    Scaling is folded into slopes and intercept; every model's numbers are literals.
    """
    names = sorted(fitted.coefficients)
    place = F.array_position(F.array(*[F.lit(m) for m in names]), model).cast("int")

    def of_model(values: Iterable[float]) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), place)

    prep, beta, k = fitted.preprocessing, fitted.coefficients, len(fitted.numeric)
    slopes = {m: beta[m][:k] / prep[m].stds for m in names}
    total = of_model(beta[m][-1] - slopes[m] @ prep[m].means for m in names)
    for i, c in enumerate(fitted.numeric):
        value = F.coalesce(lenient_double(F.col(c)), of_model(prep[m].medians[i] for m in names))
        total = total + of_model(slopes[m][i] for m in names) * value
    start = k
    for i, (c, values) in enumerate(zip(fitted.categorical, fitted.categories)):
        weights = {m: beta[m][start : start + len(values)] * prep[m].kept[i] for m in names}
        start += len(values)
        if not values:
            continue
        missing = of_model(weights[m][prep[m].modes[i]] if prep[m].modes[i] >= 0 else 0.0 for m in names)
        text = F.col(c).cast("string")
        # Value -> its weight in every model; an unknown value has none.
        pairs = [x for j, v in enumerate(values) for x in (F.lit(v), F.array(*[F.lit(float(weights[m][j])) for m in names]))]
        known = F.coalesce(F.element_at(F.try_element_at(F.create_map(*pairs), text), place), F.lit(0.0))
        effect = F.when(text.isNull(), missing).otherwise(known)
        total = total + effect
    return total


def score_logistic_folds(folded: DataFrame, fitted: FoldModels, positive: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Adds ``score`` of the positive class and ``prediction``, each row by the model that has not seen its fold."""
    positive = positive or fitted.classes[-1]
    other = next(c for c in fitted.classes if c != positive)
    sign = 1.0 if positive == fitted.classes[1] else -1.0
    score = 1.0 / (1.0 + F.exp(-sign * linear_score(fitted, F.col("fold").cast("int"))))
    return folded.withColumn("score", score).withColumn("prediction", F.when(F.col("score") >= threshold, positive).otherwise(other))


def fold_coefficients(folded: DataFrame, fitted: FoldModels) -> DataFrame:
    """``fold, term, coefficient``: the scaled models, fold -1 for that of all rows."""
    rows = [(m, t, float(c)) for m, beta in sorted(fitted.coefficients.items()) for t, c in zip(fitted.terms, beta)]
    return folded.sparkSession.createDataFrame(rows, "fold int, term string, coefficient double")
