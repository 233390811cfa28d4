"""Trends whose slope changes at a few places, with yearly waves, per series.

The slope changes have an absolute-value (Laplace) penalty, so most of them are exactly zero; level, slope and
waves have wide squared ones. Series of one length and end share a design and its Gram matrix: numpy sees
the values only through their products with the design. For a given noise variance the squared-penalty
part is solved out and the slope changes are found by coordinate descent, all series of a batch in step;
the variance follows from the residuals, and both are repeated until they agree.

An interval holds three things: how well level, slope, waves and the changes found are known (normal around
the fit), slope changes still to come (drawn as often and as large as those of the past, from a seed
that each series' keys give) and noise. So intervals widen with the step, and a rerun repeats them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.functions.dates import period_index
from casecurve.operators.forecast import as_arrays, spread_out
from casecurve.operators.series import KEYS, future_periods

# Periods in a year.
YEARS = {"month": 12.0, "week": 365.25 / 7, "day": 365.25}
# Prior scales of level and slope and of the noise, share of a series that may hold changes,
# default interval and number of draws.
LEVEL_SCALE, NOISE_SCALE, CHANGE_RANGE = 5.0, 0.5, 0.8
COVERAGE, SAMPLES, SEED = 0.8, 1000, 42
_ROUNDS, _SWEEPS, _TOLERANCE = 300, 12, 1e-7
_LEAST_VARIANCE = 1e-10
_BATCH = 256


def change_places(n: int, changepoints: int) -> np.ndarray:
    """Places (0 to 1) of the possible changes: evenly over the first four fifths, never on the first value."""
    span = max(1, int(n * CHANGE_RANGE))
    wanted = min(changepoints, span - 1)
    if wanted <= 0:
        return np.zeros(0)
    return np.unique(np.round(np.linspace(0, span - 1, wanted + 1))[1:]) / max(1, n - 1)


def waves(index: np.ndarray, harmonics: int, year: float) -> np.ndarray:
    """Sine and cosine columns of yearly waves; faster ones than two periods cannot be told apart and are left out."""
    angles = [2 * np.pi * k * index / year for k in range(1, min(harmonics, int(year // 2)) + 1)]
    return np.column_stack([np.zeros((len(index), 0)), *[f(a) for a in angles for f in (np.sin, np.cos)]])


def bends(t: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.maximum(t[:, None] - places, 0.0)


def swept(gram: np.ndarray, product: np.ndarray, penalty: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Some sweeps of coordinate descent towards least squares with an absolute-value penalty, for a batch.

    ``gram`` (p, p, b) and ``product`` (p, b) have the series last, so that a coordinate of all of them lies together.
    """
    beta = beta.copy()
    rest = product - np.einsum("ijb,jb->ib", gram, beta)
    for _ in range(_SWEEPS):
        moved = 0.0
        for j in range(len(beta)):
            size = np.maximum(gram[j, j], 1e-12)
            pull = rest[j] + size * beta[j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0.0) / size
            step = new - beta[j]
            if step.any():
                rest -= gram[:, j] * step
                beta[j] = new
                moved = max(moved, float(np.abs(step).max()))
        if moved < _TOLERANCE / 10:
            break
    return beta


def solved(x: np.ndarray, z: np.ndarray, y: np.ndarray, ridge: np.ndarray, change_scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(smooth weights, slope changes, noise variance) of the most likely fit of every row of ``y``.

    ``x`` holds level, slope and waves with prior deviations ``ridge``, ``z`` the bends. Minimised is
    n/2 log v + squares/2v + sum (weight/ridge)^2/2 + sum |change|/change_scale + v / 2 NOISE_SCALE^2, a few
    sweeps over the changes and one step of the variance in turns. Series that have settled leave the batch.
    """
    n = y.shape[1]
    xx, xz, zz = x.T @ x, x.T @ z, z.T @ z
    weights, delta = np.zeros((len(y), x.shape[1])), np.zeros((len(y), z.shape[1]))
    v = np.maximum(y.var(axis=1), 1e-4)
    a = 1.0 / NOISE_SCALE**2
    rows = np.arange(len(y))
    for _ in range(_ROUNDS):
        here = y[rows]
        left = xx + v[rows, None, None] * np.diag(1.0 / ridge**2)
        both = np.linalg.solve(left, np.concatenate([np.repeat(xz[None], len(rows), axis=0), (here @ x)[:, :, None]], axis=2))
        new = delta[rows]
        if z.shape[1]:
            gram = np.ascontiguousarray((zz - xz.T @ both[:, :, :-1]).transpose(1, 2, 0))
            product = (here @ z - both[:, :, -1] @ xz).T
            new = swept(gram, product, v[rows] / change_scale, new.T).T
        weights[rows] = both[:, :, -1] - np.einsum("bij,bj->bi", both[:, :, :-1], new)
        squares = np.square(here - weights[rows] @ x.T - new @ z.T).sum(axis=1)
        # The variance where n/2 log v + squares/2v + v/2s^2 is least.
        wide = np.maximum((np.sqrt(n * n + 4 * a * squares) - n) / (2 * a), _LEAST_VARIANCE)
        still = (np.abs(wide - v[rows]) > _TOLERANCE * wide) | (np.abs(new - delta[rows]).max(axis=1, initial=0.0) > _TOLERANCE)
        delta[rows], v[rows] = new, wide
        rows = rows[still]
        if not len(rows):
            break
    return weights, delta, v


def uncertainty(x: np.ndarray, z: np.ndarray, y: np.ndarray, ridge: np.ndarray, weights: np.ndarray, delta: np.ndarray, v: float) -> tuple[float, np.ndarray]:
    """Noise deviation by degrees of freedom, and the covariance of weights and changes; zero for changes that were not made."""
    active = np.flatnonzero(delta)
    a = np.column_stack([x, z[:, active]])
    e = y - x @ weights - z @ delta
    sigma2 = float(e @ e) / max(1, len(y) - a.shape[1])
    prior = np.concatenate([v / ridge**2, np.full(len(active), 1e-9)])
    at = np.concatenate([np.arange(x.shape[1]), x.shape[1] + active])
    cov = np.zeros((x.shape[1] + z.shape[1],) * 2)
    cov[np.ix_(at, at)] = sigma2 * np.linalg.inv(a.T @ a + np.diag(prior))
    return sigma2**0.5, cov


def fit_piecewise(
    series: DataFrame,
    keys: Sequence[str] = KEYS,
    growth: str = "linear",
    changepoints: int = 25,
    change_scale: float = 0.05,
    harmonics: int = 0,
    wave_scale: float = 10.0,
    period: str = "month",
) -> DataFrame:
    """One row per series: scale, level, slope, places and sizes of slope changes, wave weights, noise deviation,
    and the covariance of all weights (by rows).

    ``growth="flat"`` is a level without slope or changes. Values are divided by their largest magnitude and
    time runs from 0 to 1 over the series, so the prior scales mean the same for every series. A series of
    one value is its level; one that is zero everywhere stays zero.
    """
    if growth not in ("linear", "flat"):
        raise ValueError("growth is linear or flat")
    year = YEARS[period]

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                part = batch.iloc[start : start + _BATCH].reset_index(drop=True)
                found: list[tuple] = [()] * len(part)
                for (n, last), same in part.groupby([part["values"].map(len), part["last_index"]]):
                    y = np.stack(same["values"].to_numpy()).astype(float)
                    scale = np.abs(y).max(axis=1)
                    scale[scale == 0] = 1.0
                    t = np.arange(n) / max(1, n - 1)
                    trend = [np.ones(n), t] if growth == "linear" else [np.ones(n)]
                    x = np.column_stack([*trend, waves(np.arange(last - n + 1, last + 1), harmonics, year)])
                    places = change_places(n, changepoints) if growth == "linear" else np.zeros(0)
                    ridge = np.array([LEVEL_SCALE] * len(trend) + [wave_scale] * (x.shape[1] - len(trend)))
                    z = bends(t, places)
                    weights, delta, v = solved(x, z, y / scale[:, None], ridge, change_scale)
                    slope = weights[:, 1] if growth == "linear" else np.zeros(len(y))
                    for i, row in enumerate(same.index):
                        wave = weights[i, len(trend) :].tolist()
                        sigma, cov = uncertainty(x, z, y[i] / scale[i], ridge, weights[i], delta[i], v[i])
                        changes = delta[i].tolist()
                        found[row] = (scale[i], weights[i, 0], slope[i], places.tolist(), changes, wave, sigma, cov.ravel().tolist())
                names = ["scale", "level", "slope", "places", "changes", "waves", "sigma", "covariance"]
                yield pd.concat([part[[*keys, "last_ds", "last_index", "n"]], pd.DataFrame(found, columns=names)], axis=1)

    arrays = spread_out(as_arrays(series, keys), keys).withColumn("last_index", period_index(F.col("last_ds"), period).cast("long"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arrays.select(*keys, "last_ds", "last_index", "n").schema)
    schema = "scale double, level double, slope double, places array<double>, changes array<double>, waves array<double>, sigma double, covariance array<double>"
    return arrays.mapInPandas(fit, f"{kept}, {schema}")


def drawn_paths(
    rng: np.random.Generator, steps: np.ndarray, changes: np.ndarray, sigma: float, covariance: np.ndarray, samples: int
) -> np.ndarray:
    """(sample, step) departures from the fit at times ``steps`` after the end: its own error, slope changes to come, noise."""
    mean = float(np.abs(changes).mean()) if len(changes) else 0.0
    out = rng.normal(0.0, sigma, (samples, len(steps)))
    values, axes = np.linalg.eigh(covariance)
    out += rng.normal(size=out.shape) @ (axes * np.sqrt(np.maximum(values, 0.0))).T
    if mean > 0:
        # As many changes in a unit of time as the past had places for.
        counts = rng.poisson(len(changes) * steps[-1], samples)
        sample = np.repeat(np.arange(samples), counts)
        when = rng.uniform(0.0, steps[-1], len(sample))
        size = rng.laplace(0.0, mean, len(sample))
        np.add.at(out, sample, size[:, None] * np.maximum(steps - when[:, None], 0.0))
    return out


def predict_piecewise(
    params: DataFrame,
    steps: int,
    keys: Sequence[str] = KEYS,
    period: str = "month",
    coverage: float = COVERAGE,
    samples: int = SAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """Forecasts with intervals of ``coverage`` from ``samples`` drawn futures per series."""
    year = YEARS[period]
    low, high = (1 - coverage) / 2, (1 + coverage) / 2

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            paths = []
            for row in batch.itertuples(index=False):
                changes, places = np.array(row.changes, dtype=float), np.array(row.places, dtype=float)
                ahead = np.arange(1, steps + 1) / max(1, row.n - 1)
                wave = np.array(row.waves, dtype=float)
                index = np.arange(row.last_index + 1, row.last_index + steps + 1)
                size = round(len(row.covariance) ** 0.5)
                level = [np.ones(steps), 1 + ahead][: size - len(wave) - len(changes)]
                design = np.column_stack([*level, waves(index, len(wave) // 2, year), bends(1 + ahead, places)])
                y = design @ np.concatenate([[row.level, row.slope][: len(level)], wave, changes])
                name = "\x1f".join(str(getattr(row, k)) for k in keys)
                rng = np.random.default_rng([seed, zlib.crc32(name.encode())])
                spread = design @ np.array(row.covariance, dtype=float).reshape(size, size) @ design.T
                drawn = np.quantile(drawn_paths(rng, ahead, changes, row.sigma, spread, samples), [low, high], axis=0)
                paths.append((row.scale * np.stack([y, y + drawn[0], y + drawn[1]], axis=1)).tolist())
            yield batch[[*keys, "last_ds"]].assign(path=paths)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in params.select(*keys, "last_ds").schema)
    drawn = params.mapInPandas(predict, f"{kept}, path array<array<double>>")
    at = F.element_at("path", F.col("step"))
    return future_periods(drawn, steps, keys, period).select(
        *keys, "ds", "step", F.element_at(at, 1).alias("yhat"), F.element_at(at, 2).alias("yhat_lower"), F.element_at(at, 3).alias("yhat_upper")
    )
