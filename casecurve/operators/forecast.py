"""Forecast models that run for every series at once.

Each ``fit_*`` returns one row per series (a parameter table that can be stored), each
``predict_*`` turns such a table into ``keys, ds, step, yhat``. Series are already reduced to one
row per period, so a series' values fit in one array whatever the size of the line list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.dates import period_index
from casecurve.functions.numbers import whole_cases
from casecurve.operators.series import KEYS, future_periods

SEASON = 12
# Fixed value: two-sided normal quantile of the default 80 % prediction interval.
INTERVAL_Z = 1.2815515655446004


def as_arrays(series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per series: its values in time order, last period and length."""
    ordered = F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))
    return series.groupBy(*keys).agg(ordered.alias("_rows")).select(
        *keys,
        F.transform("_rows", lambda r: r["y"]).alias("values"),
        F.element_at("_rows", -1)["ds"].alias("last_ds"),
        F.size("_rows").alias("n"),
    )


def rounded_forecast(predictions: DataFrame) -> DataFrame:
    """Adds ``predicted_cases``, the whole non-negative count behind ``yhat``."""
    return predictions.withColumn("predicted_cases", whole_cases(F.col("yhat")))


def spread_out(arrays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series over all cores before a costly fit.

    A few thousand series are few bytes, which adaptive execution would gather into one task; an
    explicit number of partitions is left alone.
    """
    spark = arrays.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return arrays.repartition(parts, *keys)


# -- flat, linear and seasonal-mean levels ------------------------------------------------------


def fit_trend(series: DataFrame, growth: str = "linear", keys: Sequence[str] = KEYS, period: str = "month") -> DataFrame:
    """Least-squares level (``flat``) or line (``linear``) over the period index, with residual spread."""
    index, y = period_index(F.col("ds"), period).cast("double"), F.col("y").cast("double")
    if growth == "flat":
        slope, intercept, sse = F.lit(0.0), F.avg(y), F.regr_syy(y, index)
    else:
        slope = F.coalesce(F.regr_slope(y, index), F.lit(0.0))
        intercept = F.coalesce(F.regr_intercept(y, index), F.avg(y))
        sse = F.regr_syy(y, index) - slope * F.regr_sxy(y, index)
    return series.groupBy(*keys).agg(
        slope.alias("slope"),
        intercept.alias("intercept"),
        F.sqrt(F.greatest(sse, F.lit(0.0)) / F.count(y)).alias("sigma"),
        F.max("ds").alias("last_ds"),
    )


def predict_trend(
    params: DataFrame, steps: int, keys: Sequence[str] = KEYS, z: float = INTERVAL_Z, period: str = "month"
) -> DataFrame:
    """Point forecast with a symmetric interval of ``z`` residual deviations."""
    future = future_periods(params, steps, keys, period)
    yhat = F.col("intercept") + F.col("slope") * period_index(F.col("ds"), period)
    return future.select(
        *keys,
        "ds",
        "step",
        yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"),
        (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )


def fit_seasonal_mean(series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Average of each month of year; a month never seen takes the series average."""
    month = F.month("ds")
    means = [F.coalesce(F.avg(F.when(month == m, F.col("y"))), F.avg("y")) for m in range(1, 13)]
    return series.groupBy(*keys).agg(F.array(*means).alias("month_means"), F.max("ds").alias("last_ds"))


def predict_seasonal_mean(params: DataFrame, steps: int, keys: Sequence[str] = KEYS, period: str = "month") -> DataFrame:
    return future_periods(params, steps, keys, period).select(
        *keys, "ds", "step", F.element_at("month_means", F.month("ds")).alias("yhat")
    )


# -- Holt-Winters: level plus additive season, no trend -----------------------------------------


def _smoothed(values: Column, alpha: Column, gamma: Column, length: int, begin: Column | None = None) -> Column:
    """Folds one series: struct(sse, alpha, gamma, level, season).

    Start: ``begin`` (level, then the season), else level = mean of the first season and season = first
    values minus that level. With e the one-step error, the level moves by alpha * e and the current
    season entry by gamma * e.
    """
    first = F.slice(values, 1, length)
    level0 = F.aggregate(first, F.lit(0.0), lambda a, x: a + x) / F.size(first)
    # A series shorter than one season keeps zeros for the months it has not reached.
    season0 = F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda i: F.coalesce(F.try_element_at(values, i) - level0, F.lit(0.0)),
    )
    if begin is not None:
        level0, season0 = F.element_at(begin, 1), F.slice(begin, 2, length)
    start = F.struct(
        F.lit(0.0).alias("sse"), level0.alias("level"), season0.alias("season"), F.lit(0).alias("t")
    )

    def step(state: Column, y: Column) -> Column:
        slot = state["t"] % length
        error = y - state["level"] - F.element_at(state["season"], slot + 1)
        return F.struct(
            (state["sse"] + error * error).alias("sse"),
            (state["level"] + alpha * error).alias("level"),
            F.transform(state["season"], lambda s, i: F.when(i == slot, s + gamma * error).otherwise(s)).alias("season"),
            (state["t"] + 1).alias("t"),
        )

    return F.aggregate(
        values,
        start,
        step,
        lambda state: F.struct(
            state["sse"].alias("sse"), alpha.alias("alpha"), gamma.alias("gamma"),
            state["level"].alias("level"), state["season"].alias("season"),
        ),
    )


def padded(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Series of a batch as the rows of one matrix, filled up with zeros, and their lengths."""
    lengths = values.map(len).to_numpy()
    matrix = np.zeros((len(values), int(lengths.max())))
    for row, v in zip(matrix, values):
        row[: len(v)] = v
    return matrix, lengths


def _squared_errors(y: np.ndarray, n: np.ndarray, alpha: np.ndarray, gamma: np.ndarray, length: int) -> np.ndarray:
    """Sum of squared one-step errors for (series, candidate) weights, all in step with time."""
    seen = np.minimum(n, length)
    level = np.repeat((y[:, :length].sum(axis=1) / seen)[:, None], alpha.shape[1], axis=1)
    start = np.zeros((len(y), length))
    reach = min(length, y.shape[1])
    start[:, :reach] = np.where(np.arange(reach) < n[:, None], y[:, :reach] - level[:, :1], 0.0)
    season = np.repeat(start.T[:, :, None], alpha.shape[1], axis=2)
    total = np.zeros_like(alpha)
    for t in range(y.shape[1]):
        error = np.where((t < n)[:, None], y[:, t, None] - level - season[t % length], 0.0)
        total += error * error
        level = level + alpha * error
        season[t % length] += gamma * error
    return total


def _best_weights(y: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """(alpha, gamma) of the smallest error over 0 <= gamma <= 1 - alpha, per series.

    A grid of tenths, then two finer grids around each series' best point.
    """
    tenths = [(a / 10, g / 10) for a in range(11) for g in range(11 - a)]
    best = np.zeros((len(y), 2))
    for offsets in (tenths, *([(i * w, j * w) for i in range(-3, 4) for j in range(-3, 4)] for w in (0.025, 0.005))):
        grid = best[:, None, :] + np.array(offsets)[None, :, :]
        alpha = np.clip(grid[:, :, 0], 0.0, 1.0)
        gamma = np.clip(grid[:, :, 1], 0.0, 1.0 - alpha)
        chosen = _squared_errors(y, n, alpha, gamma, length).argmin(axis=1)
        rows = np.arange(len(y))
        best = np.stack([alpha[rows, chosen], gamma[rows, chosen]], axis=1)
    return best


def _best_start(y: np.ndarray, n: np.ndarray, weights: np.ndarray, length: int) -> np.ndarray:
    """(level, season...) of the smallest error for given weights, per series.

    Errors are linear in the start, so one run from zero and one from each unit start give the
    least-squares problem. Of equal starts that with a season around 0 is taken.
    """
    parts = length + 1
    begin = np.concatenate([np.zeros((1, parts)), np.eye(parts)])
    level = np.repeat(begin[None, :, 0], len(y), axis=0)
    season = np.repeat(begin[None, :, 1:], len(y), axis=0)
    alpha, gamma = weights[:, :1], weights[:, 1:]
    errors = np.zeros((len(y), y.shape[1], parts + 1))
    for t in range(y.shape[1]):
        observed = np.zeros((len(y), parts + 1))
        observed[:, 0] = y[:, t]
        error = np.where((t < n)[:, None], observed - level - season[:, :, t % length], 0.0)
        errors[:, t] = error
        level = level + alpha * error
        season[:, :, t % length] += gamma * error
    balanced = np.concatenate([[0.0], np.ones(length)])
    return np.stack(
        [np.linalg.lstsq(np.vstack([e[:, 1:], balanced]), -np.append(e[:, 0], 0.0), rcond=None)[0] for e in errors]
    )


def _run(y: np.ndarray, n: np.ndarray, weights: np.ndarray, begin: np.ndarray, length: int, slopes: bool):
    """Squared error per series and, with ``slopes``, the sums J'J and J'e of the errors' derivatives.

    The derivatives of level and season by (alpha, gamma, level, season...) are carried along the recursion.
    """
    many, parts = len(y), length + 3
    alpha, gamma = weights[:, 0], weights[:, 1]
    level, season = begin[:, 0].copy(), begin[:, 1:].copy()
    sse = np.zeros(many)
    square, product = np.zeros((many, parts, parts)), np.zeros((many, parts))
    d_level, d_season = np.zeros((many, parts)), np.zeros((many, length, parts))
    d_level[:, 2] = 1.0
    d_season[:, np.arange(length), np.arange(3, parts)] = 1.0
    for t in range(y.shape[1]):
        live, slot = t < n, t % length
        error = np.where(live, y[:, t] - level - season[:, slot], 0.0)
        sse += error * error
        if slopes:
            d = np.where(live[:, None], -(d_level + d_season[:, slot]), 0.0)
            square += d[:, :, None] * d[:, None, :]
            product += d * error[:, None]
            d_level = d_level + alpha[:, None] * d
            d_level[:, 0] += error
            d_season[:, slot] += gamma[:, None] * d
            d_season[:, slot, 1] += error
        level = level + alpha * error
        season[:, slot] += gamma * error
    return (sse, square, product) if slopes else sse


def _joint(y: np.ndarray, n: np.ndarray, weights: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights, level and season fitted together by damped Gauss-Newton steps from given ones.

    Every series has its own damping; a step that leaves 0 <= gamma <= 1 - alpha is brought back to it, and
    only steps that lower the squared error are taken, so the result is never worse than the start.
    """
    weights, begin = weights.copy(), begin.copy()
    sse = _run(y, n, weights, begin, length, False)
    damping, still = np.full(len(y), 1e-2), np.zeros(len(y), int)
    for _ in range(80):
        rows = np.flatnonzero((still < 4) & (damping < 1e8) & (sse > 0))
        if not len(rows):
            break
        _, square, product = _run(y[rows], n[rows], weights[rows], begin[rows], length, True)
        ridge = damping[rows, None] * (np.einsum("bii->bi", square) + 1e-9 * np.einsum("bii->b", square)[:, None] + 1e-12)
        square[:, np.arange(length + 3), np.arange(length + 3)] += ridge
        move = -np.linalg.solve(square, product[:, :, None])[:, :, 0]
        alpha = np.clip(weights[rows, 0] + move[:, 0], 0.0, 1.0)
        gamma = np.clip(weights[rows, 1] + move[:, 1], 0.0, 1.0 - alpha)
        tried, start = np.stack([alpha, gamma], axis=1), begin[rows] + move[:, 2:]
        found = _run(y[rows], n[rows], tried, start, length, False)
        better = found < sse[rows]
        good = rows[better]
        small = sse[good] - found[better] <= 1e-10 * sse[good]
        still[good] = np.where(small, still[good] + 1, 0)
        weights[good], begin[good], sse[good] = tried[better], start[better], found[better]
        damping[rows] = np.where(better, np.maximum(damping[rows] / 5, 1e-9), damping[rows] * 4)
    # The start for the weights found, once more by least squares.
    last = _best_start(y, n, weights, length)
    better = _run(y, n, weights, last, length, False) < sse
    begin[better] = last[better]
    # Of starts that differ by a constant between level and season, that with a season around 0.
    middle = begin[:, 1:].mean(axis=1)
    begin[:, 0] += middle
    begin[:, 1:] -= middle[:, None]
    return weights, begin


def _search_weights(batches: Iterator[pd.DataFrame], length: int, start: str) -> Iterator[pd.DataFrame]:
    for batch in batches:
        # A few hundred series at a time keep the working arrays small.
        for first in range(0, len(batch), 256):
            part = batch.iloc[first : first + 256]
            y, n = padded(part["values"])
            given = "alpha" in part
            weights = part[["alpha", "gamma"]].to_numpy() if given else _best_weights(y, n, length)
            begin = None if start == "first" else _best_start(y, n, weights, length)
            if start == "joint" and not given:
                weights, begin = _joint(y, n, weights, begin, length)
            part = part.assign(alpha=weights[:, 0], gamma=weights[:, 1])
            yield part if begin is None else part.assign(begin=list(begin))


def fit_holt_winters(
    series: DataFrame,
    keys: Sequence[str] = KEYS,
    alpha: float | None = None,
    gamma: float | None = None,
    season: int = SEASON,
    start: str = "first",
) -> DataFrame:
    """One row per series: alpha, gamma, level, season ring of ``season`` periods, sse.

    With both weights given they are used as they are. Otherwise they are searched with numpy for
    all series of an Arrow batch together; the fold that yields level and season is the same. It starts
    from the ``first`` season, from the ``estimated`` level and season of the least squared error for the
    weights found from the first season, or from weights, level and season fitted ``joint``ly from there.
    """
    if start not in ("first", "estimated", "joint"):
        raise ValueError("the start is first, estimated or joint")
    arrays = spread_out(as_arrays(series, keys), keys)
    if alpha is not None and gamma is not None:
        arrays = arrays.withColumns({"alpha": F.lit(float(alpha)), "gamma": F.lit(float(gamma))})
    if start != "first" or "alpha" not in arrays.columns:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arrays.schema)
        columns += "" if "alpha" in arrays.columns else ", alpha double, gamma double"
        columns += "" if start == "first" else ", begin array<double>"
        arrays = arrays.mapInPandas(partial(_search_weights, length=season, start=start), columns)
    fit = _smoothed(F.col("values"), F.col("alpha"), F.col("gamma"), season, None if start == "first" else F.col("begin"))
    return arrays.withColumn("_fit", fit).select(*keys, "_fit.*", "n", "last_ds")


def predict_holt_winters(params: DataFrame, steps: int, keys: Sequence[str] = KEYS, period: str = "month") -> DataFrame:
    """Level plus the season entry of the step's place in the ring."""
    slot = (F.col("n") + F.col("step") - 1) % F.size("season")
    return future_periods(params, steps, keys, period).select(
        *keys, "ds", "step", (F.col("level") + F.element_at("season", slot.cast("int") + 1)).alias("yhat")
    )
