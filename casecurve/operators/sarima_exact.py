"""Seasonal ARIMA per series by exact maximum likelihood.

The model (1,d,1)x(1,0,Q)s with d and Q in {0, 1} is a state-space model whose state holds the next ``r``
predictions' parts. A Kalman filter runs over a batch of series (and of candidate parameters) in step with
time: one numpy operation per time step for all of them. The noise variance is concentrated out, and the
coefficients are searched by a quasi-Newton method, all series of the batch together, each with its own
step length. Spark spreads the series over tasks; a series is one short array.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.operators import arima
from casecurve.operators.forecast import INTERVAL_Z, SEASON, as_arrays, padded, spread_out
from casecurve.operators.series import KEYS, future_periods

# Variance of an unknown start, in units of the noise variance.
DIFFUSE = 1e6
ITERATIONS = 60
_BATCH = 64
_LEAST_VARIANCE = 1e-12
_STEP = 1e-5


class Filtered(NamedTuple):
    """Per model: log-likelihood at its best noise variance, that variance, and the state predicted after the last value."""

    loglik: np.ndarray
    sigma2: np.ndarray
    state: np.ndarray


def polynomials(params: np.ndarray, q: int, season: int) -> tuple[np.ndarray, np.ndarray]:
    """``phi`` (weights of the last r values) and ``theta`` (of the noise: 1, then r - 1 lags) for rows (ar, sar, ma, sma)."""
    ar, sar, ma, sma = params.T
    lags_ma = season + 1 if q else 1
    r = max(season + 1, lags_ma + 1)
    phi, theta = np.zeros((len(params), r)), np.zeros((len(params), r))
    # += because the lags of a season of one period coincide.
    phi[:, 0] += ar
    phi[:, season - 1] += sar
    phi[:, season] -= ar * sar
    theta[:, 0] = 1.0
    theta[:, 1] += ma
    if q:
        theta[:, season] += sma
        theta[:, season + 1] += ma * sma
    return phi, theta


def _shifted(square: np.ndarray) -> np.ndarray:
    """Rows and columns moved up and left by one, zeros at the end."""
    out = np.zeros_like(square)
    out[:, :-1, :-1] = square[:, 1:, 1:]
    return out


def stationary_spread(phi: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """Covariance of the state of a stationary model, by doubling: P = sum of T^k R R' T'^k."""
    r = phi.shape[1]
    power = np.zeros((len(phi), r, r))
    power[:, :, 0] = phi
    power[:, np.arange(r - 1), np.arange(1, r)] += 1.0
    spread = theta[:, :, None] * theta[:, None, :]
    for _ in range(40):
        more = power @ spread @ power.transpose(0, 2, 1)
        spread = spread + more
        if np.abs(more).max() <= 1e-13 * np.abs(spread).max():
            break
        power = power @ power
    return spread


def filtered(w: np.ndarray, n: np.ndarray, params: np.ndarray, q: int, season: int = SEASON, initial: str = "stationary") -> Filtered:
    """Runs the filter for every row of ``w`` (zero-padded, ``n`` values each) under its row of (ar, sar, ma, sma).

    With ``initial="stationary"`` the state starts from its stationary distribution, so the likelihood is that of
    the joint normal density of all values. With ``"diffuse"`` it starts unknown (variance 1e6), the first ``r``
    values only settle it and are not scored; the coefficients need not be stationary.
    """
    phi, theta = polynomials(params, q, season)
    noise = theta[:, :, None] * theta[:, None, :]
    r = phi.shape[1]
    unscored = 0
    if initial == "stationary":
        spread = stationary_spread(phi, theta)
    else:
        spread, unscored = np.repeat(DIFFUSE * np.eye(r)[None], len(w), axis=0), r
    state = np.zeros((len(w), r))
    log_scale, squares = np.zeros(len(w)), np.zeros(len(w))
    with np.errstate(all="ignore"):
        for t in range(w.shape[1]):
            live = t < n
            scale = spread[:, 0, 0]
            error = w[:, t] - state[:, 0]
            scored = live & (t >= unscored)
            log_scale += np.where(scored, np.log(scale), 0.0)
            squares += np.where(scored, error * error / scale, 0.0)
            gain = spread[:, :, 0] / scale[:, None]
            # After the update the first entry of the state is the value itself, without error.
            updated = state + gain * error[:, None]
            following = phi * w[:, t, None]
            following[:, :-1] += updated[:, 1:]
            state = np.where(live[:, None], following, state)
            wider = _shifted(spread - gain[:, :, None] * spread[:, None, 0, :]) + noise
            spread = np.where(live[:, None, None], wider, spread)
        used = np.maximum(n - unscored, 1)
        sigma2 = np.maximum(squares / used, _LEAST_VARIANCE)
        loglik = -0.5 * (used * (np.log(2 * np.pi * sigma2) + 1.0) + log_scale)
    loglik = np.where(np.isfinite(loglik), loglik, -np.inf)
    return Filtered(loglik, sigma2, state)


def _to_params(free: np.ndarray, initial: str) -> np.ndarray:
    """Any real numbers to coefficients: of a stationary model, the autoregressive ones lie within (-1, 1)."""
    params = np.zeros((*free.shape[:-1], 4))
    params[..., : free.shape[-1]] = free
    if initial == "stationary":
        params[..., :2] = np.tanh(params[..., :2])
    return params


def _to_free(params: np.ndarray, k: int, initial: str) -> np.ndarray:
    free = params[:, :k].copy()
    if initial == "stationary":
        free[:, :2] = np.arctanh(np.clip(free[:, :2], -0.999999, 0.999999))
    return free


def _logliks(w: np.ndarray, n: np.ndarray, free: np.ndarray, q: int, season: int, initial: str) -> np.ndarray:
    """Log-likelihood (series, candidate) of ``free`` (series, candidate, coefficient)."""
    many = free.shape[1]
    params = _to_params(free, initial).reshape(-1, 4)
    return filtered(np.repeat(w, many, axis=0), np.repeat(n, many), params, q, season, initial).loglik.reshape(len(w), many)


def _gradient(w: np.ndarray, n: np.ndarray, at: np.ndarray, q: int, season: int, initial: str) -> np.ndarray:
    """Central differences of the negative log-likelihood, all directions of all series in one run of the filter."""
    k = at.shape[1]
    moves = _STEP * np.concatenate([np.eye(k), -np.eye(k)])
    values = _logliks(w, n, at[:, None, :] + moves, q, season, initial)
    with np.errstate(invalid="ignore"):
        slope = (values[:, k:] - values[:, :k]) / (2 * _STEP)
    return np.where(np.isfinite(slope), slope, 0.0)


def maximised(w: np.ndarray, n: np.ndarray, start: np.ndarray, q: int, season: int = SEASON, initial: str = "stationary") -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, log-likelihood) from BFGS steps for all series at once; never below the likelihood at ``start``.

    Every series has its own inverse Hessian and step length. A series is done when its gradient is flat or no
    step of the line search gains; the batch goes on with the others.
    """
    k = start.shape[1]
    at = start.copy()
    value = -_logliks(w, n, at[:, None, :], q, season, initial)[:, 0]
    slope = _gradient(w, n, at, q, season, initial)
    inverse = np.repeat(np.eye(k)[None], len(w), axis=0)
    going = np.isfinite(value)
    steps = 0.5 ** np.arange(8)
    for _ in range(ITERATIONS):
        rows = np.flatnonzero(going & (np.abs(slope).max(axis=1) > 1e-5))
        if not len(rows):
            break
        move = -np.einsum("bij,bj->bi", inverse[rows], slope[rows])
        downhill = np.einsum("bi,bi->b", move, slope[rows])
        lost = downhill >= 0
        move[lost] = -slope[rows][lost]
        inverse[rows[lost]] = np.eye(k)
        downhill = np.minimum(downhill, -1e-300)
        # No step of more than 1 in any coefficient: the scale is that of correlations.
        move /= np.maximum(1.0, np.abs(move).max(axis=1))[:, None]
        tried = at[rows][:, None, :] + steps[:, None] * move[:, None, :]
        found = -_logliks(w[rows], n[rows], tried, q, season, initial)
        enough = found <= value[rows][:, None] + 1e-4 * steps * downhill[:, None]
        # The longest step that gains enough, else the best one if it gains at all.
        chosen = np.where(enough.any(axis=1), enough.argmax(axis=1), found.argmin(axis=1))
        new_value = found[np.arange(len(rows)), chosen]
        gains = new_value < value[rows]
        going[rows[~gains]] = False
        rows, chosen, new_value, tried = rows[gains], chosen[gains], new_value[gains], tried[gains]
        if not len(rows):
            continue
        new = tried[np.arange(len(rows)), chosen]
        new_slope = _gradient(w[rows], n[rows], new, q, season, initial)
        s, y = new - at[rows], new_slope - slope[rows]
        curved = np.einsum("bi,bi->b", s, y)
        fit = curved > 1e-12
        rho = np.where(fit, 1.0 / np.where(fit, curved, 1.0), 0.0)
        left = np.eye(k) - rho[:, None, None] * s[:, :, None] * y[:, None, :]
        updated = left @ inverse[rows] @ left.transpose(0, 2, 1) + rho[:, None, None] * s[:, :, None] * s[:, None, :]
        inverse[rows] = np.where(fit[:, None, None], updated, inverse[rows])
        going[rows] &= value[rows] - new_value > 1e-9 * (1.0 + np.abs(value[rows]))
        at[rows], value[rows], slope[rows] = new, new_value, new_slope
    return _to_params(at, initial), -value


def _starts(w: np.ndarray, n: np.ndarray, k: int, q: int, season: int, initial: str) -> np.ndarray:
    """Per series the likeliest of a coarse grid and, for yearly seasons, of the conditional least-squares fit."""
    ticks = np.stack(np.meshgrid(*[[-0.5, 0.0, 0.5]] * k, indexing="ij"), axis=-1).reshape(-1, k)
    tried = np.repeat(ticks[None], len(w), axis=0)
    if season == SEASON:
        tried = np.concatenate([_to_free(arima._search(w, n, k), k, initial)[:, None, :], tried], axis=1)
    return tried[np.arange(len(w)), _logliks(w, n, tried, q, season, initial).argmax(axis=1)]


def fit_sarima_exact(
    series: DataFrame,
    keys: Sequence[str] = KEYS,
    order: tuple[int, int] = arima.SERVICE_ORDER,
    params: tuple[float, float, float, float] | None = None,
    season: int = SEASON,
    initial: str = "stationary",
) -> DataFrame:
    """One row per series: ar, sar, ma, sma, sigma2, loglik, aic, and the state a forecast starts from.

    ``order`` is (d, Q). The coefficients maximise the exact likelihood of the (differenced) series; with
    ``params`` (ar, sar, ma, sma) nothing is searched. ``initial="diffuse"`` starts from an unknown state and bounds
    no coefficient, ``"stationary"`` keeps the autoregressive ones within (-1, 1); the moving-average ones
    are never bounded. ``aic`` counts the coefficients and the variance. With fewer than ``season + 2``
    (differenced) values nothing is fitted: all coefficients 0 and a null log-likelihood and aic. A series
    that is constant at zero (after differencing) has a variance of 1e-12.
    """
    if initial not in ("stationary", "diffuse"):
        raise ValueError("the initial state is stationary or diffuse")
    d, q = order
    k = 3 + q

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), _BATCH):
                part = batch.iloc[first : first + _BATCH].reset_index(drop=True)
                y, length = padded(part["values"])
                w, n = (np.diff(y, axis=1), length - 1) if d else (y, length)
                if d:  # padding must stay zero: the step down to it is no value
                    w = np.where(np.arange(w.shape[1]) < n[:, None], w, 0.0)
                enough = n >= season + 2
                best = np.zeros((len(part), 4))
                if params is not None:
                    best[enough] = params
                elif enough.any():
                    start = _starts(w[enough], n[enough], k, q, season, initial)
                    best[enough] = maximised(w[enough], n[enough], start, q, season, initial)[0]
                done = filtered(w, n, best, q, season, initial)
                phi, theta = polynomials(best, q, season)
                out = part[[*keys, "last_ds", "n"]].copy()
                for i, name in enumerate(("ar", "sar", "ma", "sma")):
                    out[name] = best[:, i]
                out["sigma2"] = done.sigma2
                out["loglik"] = [float(x) if ok and np.isfinite(x) else None for x, ok in zip(done.loglik, enough)]
                out["aic"] = [None if x is None else 2.0 * (k + 1) - 2.0 * x for x in out["loglik"]]
                out["phi"], out["theta"], out["state"] = phi.tolist(), theta.tolist(), done.state.tolist()
                out["last_y"] = [float(v[-1]) for v in part["values"]]
                yield out

    arrays = spread_out(as_arrays(series, keys), keys)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in arrays.select(*keys, "last_ds", "n").schema)
    schema = (
        f"{kept}, ar double, sar double, ma double, sma double, sigma2 double, loglik double, aic double, "
        "phi array<double>, theta array<double>, state array<double>, last_y double"
    )
    return arrays.mapInPandas(fit, schema).withColumn("d", F.lit(d))


def predict_sarima_exact(
    params: DataFrame, steps: int, keys: Sequence[str] = KEYS, period: str = "month", z: float = INTERVAL_Z
) -> DataFrame:
    """Forecasts from the filtered state, with an interval that widens by the noise still to come.

    The state moves on without noise: its first entry is the next prediction. A unit of noise follows the same
    recursion from its own weights, and the variance h steps ahead is the noise variance times the sum
    of its squared (for d = 1: accumulated) responses. What the filter does not yet know of the state
    is left out: after a few seasons it is nothing.
    """

    def on(state: Column) -> Column:
        head = F.element_at(state, 1)
        moved = F.concat(F.slice(state, 2, F.size(state)), F.array(F.lit(0.0)))
        return F.zip_with(F.col("phi"), moved, lambda a, b: a * head + b)

    def step(s: Column, _: Column) -> Column:
        w, unit = F.element_at(s["state"], 1), F.element_at(s["unit"], 1)
        summed = F.when(F.col("d") == 1, s["summed"] + unit).otherwise(unit)
        y = F.when(F.col("d") == 1, s["y"] + w).otherwise(w)
        variance = s["variance"] + summed * summed
        return F.struct(
            on(s["state"]).alias("state"), on(s["unit"]).alias("unit"), summed.alias("summed"), y.alias("y"),
            variance.alias("variance"),
            F.concat(s["path"], F.array(F.struct(y.alias("y"), variance.alias("v")))).alias("path"),
        )

    begin = F.struct(
        F.col("state").alias("state"), F.col("theta").alias("unit"), F.lit(0.0).alias("summed"), F.col("last_y").alias("y"),
        F.lit(0.0).alias("variance"), F.array().cast("array<struct<y:double,v:double>>").alias("path"),
    )
    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, step, lambda s: s["path"])
    at = F.element_at("_path", F.col("step"))
    half = z * F.sqrt(F.col("sigma2") * at["v"])
    return future_periods(params.withColumn("_path", path), steps, keys, period).select(
        *keys, "ds", "step", at["y"].alias("yhat"), (at["y"] - half).alias("yhat_lower"), (at["y"] + half).alias("yhat_upper")
    )
