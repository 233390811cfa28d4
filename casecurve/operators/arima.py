"""Seasonal ARIMA per series, fitted by conditional least squares.

Covers (1,d,1)x(1,0,Q)12 with d and Q in {0, 1}. The parameters are searched with numpy for a
few hundred series together inside ``mapInPandas``; series are spread over tasks by Spark. Unlike an
exact-likelihood fit, errors before the first 13 differenced values are taken as zero.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.operators.forecast import INTERVAL_Z, SEASON, as_arrays, padded, spread_out
from casecurve.operators.series import KEYS, future_periods

LAGS = SEASON + 1
# Orders of the service model and of the backtested model as (d, Q).
SERVICE_ORDER = (0, 0)
BACKTEST_ORDER = (1, 1)


def _errors(w: np.ndarray, n: np.ndarray, params: np.ndarray) -> Iterator[np.ndarray]:
    """One-step errors (series, candidate), one array per time step; zero outside 13 <= t < n."""
    ar, sar, ma, sma = np.moveaxis(params, 2, 0)
    past = [np.zeros(ar.shape)] * LAGS
    for t in range(w.shape[1]):
        error = past[0] * 0.0
        if t >= LAGS:
            predicted = ar * w[:, t - 1, None] + sar * w[:, t - SEASON, None] - ar * sar * w[:, t - LAGS, None]
            predicted = predicted + ma * past[0] + sma * past[SEASON - 1] + ma * sma * past[LAGS - 1]
            error = np.where((t < n)[:, None], w[:, t, None] - predicted, 0.0)
        past = [error, *past[:-1]]
        yield error


def _search(w: np.ndarray, n: np.ndarray, free: int) -> np.ndarray:
    """Least-squares (ar, sar, ma, sma) per series: a coarse grid in (-1, 1), then narrower boxes."""
    best, width = np.zeros((len(w), 4)), 0.9
    for round_no in range(9):
        ticks = np.linspace(-width, width, 5 if round_no == 0 else 3)
        offsets = np.zeros((len(ticks) ** free, 4))
        offsets[:, :free] = np.stack(np.meshgrid(*[ticks] * free, indexing="ij"), axis=-1).reshape(-1, free)
        grid = np.clip(best[:, None, :] + offsets[None, :, :], -0.99, 0.99)
        sse = np.zeros(grid.shape[:2])
        for error in _errors(w, n, grid):
            sse += error * error
        best = grid[np.arange(len(w)), np.where(np.isfinite(sse), sse, np.inf).argmin(axis=1)]
        width *= 0.5
    return best


def _tail(values: np.ndarray, n: int) -> list[float]:
    """The newest 13 of the first n values, newest first, zeros before the start."""
    return np.concatenate([np.zeros(LAGS), values[:n]])[::-1][:LAGS].tolist()


def fit_sarima(
    series: DataFrame,
    keys: Sequence[str] = KEYS,
    order: tuple[int, int] = SERVICE_ORDER,
    params: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """One row per series: ar, sar, ma, sma, sse, aic, and the newest values a forecast needs.

    With ``params`` (ar, sar, ma, sma) nothing is searched. A series with fewer than 14 (differenced) values is fitted as a random walk around zero errors:
    all parameters 0 and a null aic.
    """
    d, q = order
    n_params = 4 + q

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256].reset_index(drop=True)
                y, length = padded(part["values"])
                w, n = (np.diff(y, axis=1), length - 1) if d else (y, length)
                best = _search(w, n, 3 + q) if params is None else np.tile(np.array(params, dtype=float), (len(part), 1))
                errors = np.array([e[:, 0] for e in _errors(w, n, best[:, None, :])]).T.reshape(len(part), -1)
                used = n - LAGS
                fitted = used > 0
                best[~fitted] = 0.0
                sse = np.square(errors).sum(axis=1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    aic = used * np.log(np.maximum(sse, 1e-12) / used) + 2 * n_params
                out = part[[*keys, "last_ds", "n"]].copy()
                for i, name in enumerate(("ar", "sar", "ma", "sma")):
                    out[name] = best[:, i]
                out["sse"], out["aic"] = sse, [float(a) if ok else None for a, ok in zip(aic, fitted)]
                out["w_tail"] = [_tail(v, k) for v, k in zip(w, n)]
                out["e_tail"] = [_tail(v, k) for v, k in zip(errors, n)]
                out["last_y"] = [float(v[-1]) for v in part["values"]]
                yield out

    arrays = spread_out(as_arrays(series, keys), keys)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arrays.select(*keys, "last_ds", "n").schema)
    schema = kept + ", ar double, sar double, ma double, sma double, sse double, aic double, w_tail array<double>, e_tail array<double>, last_y double"
    return arrays.mapInPandas(fit, schema).withColumn("d", F.lit(d))


def predict_sarima(params: DataFrame, steps: int, keys: Sequence[str] = KEYS, period: str = "month") -> DataFrame:
    """Forecasts by the model's recursion with future errors at zero, summed back when d = 1."""

    def lag(state: Column, name: str, k: int) -> Column:
        return F.element_at(state[name], k)

    def step(state: Column, _: Column) -> Column:
        ar, sar, ma, sma = (F.col(c) for c in ("ar", "sar", "ma", "sma"))
        w = (
            ar * lag(state, "w", 1) + sar * lag(state, "w", SEASON) - ar * sar * lag(state, "w", LAGS)
            + ma * lag(state, "e", 1) + sma * lag(state, "e", SEASON) + ma * sma * lag(state, "e", LAGS)
        )
        y = F.when(F.col("d") == 1, state["y"] + w).otherwise(w)
        return F.struct(
            F.concat(F.array(w), F.slice(state["w"], 1, LAGS - 1)).alias("w"),
            F.concat(F.array(F.lit(0.0)), F.slice(state["e"], 1, LAGS - 1)).alias("e"),
            y.alias("y"),
            F.concat(state["path"], F.array(y)).alias("path"),
        )

    start = F.struct(
        F.col("w_tail").alias("w"), F.col("e_tail").alias("e"), F.col("last_y").alias("y"),
        F.array().cast("array<double>").alias("path"),
    )
    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda s: s["path"])
    return future_periods(params.withColumn("_path", path), steps, keys, period).select(
        *keys, "ds", "step", F.element_at("_path", F.col("step")).alias("yhat")
    )


def fit_predict_fourier(
    series: DataFrame,
    steps: int,
    keys: Sequence[str] = KEYS,
    harmonics: int = 3,
    z: float = INTERVAL_Z,
    changepoints: int = 0,
    penalty: float = 1.0,
) -> DataFrame:
    """Line plus yearly sine/cosine terms by least squares, with a symmetric interval.

    With ``changepoints`` the slope may change at that many places, evenly spread over the first four
    fifths of a series; the sum of their squared changes per century, times ``penalty``, is added to
    the squared errors. Months of the year have the angle 2*pi*month/12; a short series gets the
    minimum-norm solution. Series of one length and end share a design and are solved together.
    """

    def design(index: np.ndarray, knots: np.ndarray) -> np.ndarray:
        angle = 2 * np.pi * index / SEASON
        waves = [f(k * angle) for k in range(1, harmonics + 1) for f in (np.sin, np.cos)]
        bends = [np.maximum(index - knot, 0.0) / 100.0 for knot in knots]
        return np.column_stack([np.ones(len(index)), index / 100.0, *waves, *bends])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            paths, spreads = [None] * len(batch), np.zeros(len(batch))
            for (n, last), part in batch.groupby([batch["values"].map(len), batch["_last"]]):
                y = np.stack(part["values"].to_numpy()).astype(float).T
                # Counted back from the last period, so that season angles follow the calendar.
                index = np.arange(last - n + 1, last + 1) - 24000.0
                knots = index[0] + 0.8 * n * np.arange(1, changepoints + 1) / (changepoints + 1)
                x = design(index, knots)
                shrunk = np.sqrt(penalty) * np.eye(x.shape[1])[x.shape[1] - changepoints :]
                beta = np.linalg.lstsq(np.vstack([x, shrunk]), np.vstack([y, np.zeros((changepoints, y.shape[1]))]), rcond=None)[0]
                future = design(np.arange(last + 1, last + steps + 1) - 24000.0, knots) @ beta
                spreads[part.index] = np.sqrt(np.mean((y - x @ beta) ** 2, axis=0))
                for row, path in zip(part.index, future.T):
                    paths[row] = path.tolist()
            yield batch[[*keys, "last_ds"]].assign(path=paths, sigma=spreads)

    arrays = spread_out(as_arrays(series, keys), keys).withColumn("_last", F.year("last_ds") * 12 + F.month("last_ds"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arrays.select(*keys, "last_ds").schema)
    fitted = arrays.mapInPandas(fit, kept + ", path array<double>, sigma double")
    yhat = F.element_at("path", F.col("step"))
    return future_periods(fitted, steps, keys).select(
        *keys, "ds", "step", yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"), (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )
