"""Forecast evaluation: hold-out and rolling-origin, for all series in one job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.operators import arima, forecast, piecewise, sarima_exact
from casecurve.operators.series import KEYS, ORIGINS, holdout_split, rolling_folds
from casecurve.session import saved_table

Model = Callable[[DataFrame, int, Sequence[str], str], DataFrame]

# Periods in a season: a year of months or weeks, a week of days. Conditional seasonal ARIMA keeps to 12 periods.
SEASONS = {"month": 12, "week": 52, "day": 7}


class Fitted(NamedTuple):
    """A model in two halves: ``fit(series, keys, period)`` gives a table of parameters that can be stored,
    ``predict(params, steps, keys, period)`` forecasts from it."""

    fit: Callable[[DataFrame, Sequence[str], str], DataFrame]
    predict: Callable[[DataFrame, int, Sequence[str], str], DataFrame]

    def __call__(self, series: DataFrame, steps: int, keys: Sequence[str], period: str) -> DataFrame:
        return self.predict(self.fit(series, keys, period), steps, keys, period)


def _trend(growth: str) -> Fitted:
    return Fitted(
        lambda s, keys, p: forecast.fit_trend(s, growth, keys, p),
        lambda params, n, keys, p: forecast.predict_trend(params, n, keys, period=p),
    )


def _conditional(order: tuple[int, int]) -> Fitted:
    return Fitted(lambda s, keys, p: arima.fit_sarima(s, keys, order), arima.predict_sarima)


def _likeliest(order: tuple[int, int], initial: str) -> Fitted:
    return Fitted(
        lambda s, keys, p: sarima_exact.fit_sarima_exact(s, keys, order, season=SEASONS[p], initial=initial),
        sarima_exact.predict_sarima_exact,
    )


def _piecewise(**settings) -> Fitted:
    return Fitted(lambda s, keys, p: piecewise.fit_piecewise(s, keys, period=p, **settings), piecewise.predict_piecewise)


def _fourier(series: DataFrame, steps: int, keys: Sequence[str], period: str) -> DataFrame:
    if period != "month":
        raise ValueError("the Fourier regression has yearly waves over months")
    return arima.fit_predict_fourier(series, steps, keys)


# Every model: (training rows, steps, keys, period) -> keys, ds, step, yhat. All but one have two halves.
MODELS: dict[str, Model] = {
    "flat": _trend("flat"),
    "linear": _trend("linear"),
    "seasonal_mean": Fitted(lambda s, keys, p: forecast.fit_seasonal_mean(s, keys), forecast.predict_seasonal_mean),
    "holt_winters": Fitted(
        lambda s, keys, p: forecast.fit_holt_winters(s, keys, season=SEASONS[p], start="joint"), forecast.predict_holt_winters
    ),
    "fourier": _fourier,
    "sarima": _conditional(arima.SERVICE_ORDER),
    "sarima_backtest": _conditional(arima.BACKTEST_ORDER),
    # By exact likelihood: from a stationary start, and from an unknown one with unbounded coefficients.
    "sarima_exact": _likeliest(arima.SERVICE_ORDER, "stationary"),
    "sarima_exact_backtest": _likeliest(arima.BACKTEST_ORDER, "stationary"),
    "sarima_diffuse": _likeliest(arima.SERVICE_ORDER, "diffuse"),
    "sarima_diffuse_backtest": _likeliest(arima.BACKTEST_ORDER, "diffuse"),
    # The three settings of the trend study.
    "trend_yearly": _piecewise(harmonics=10),
    "trend_changes": _piecewise(changepoints=5, change_scale=0.01, wave_scale=0.1),
    "trend_flat": _piecewise(growth="flat"),
}


def halves(name: str) -> Fitted:
    """The model's two halves, for those whose parameters can be stored."""
    model = MODELS[name]
    if not isinstance(model, Fitted):
        raise ValueError(f"{name} has no parameters to store")
    return model


def forecast_with(
    series: DataFrame, model: str, steps: int = 6, keys: Sequence[str] = KEYS, period: str = "month"
) -> DataFrame:
    """Fits ``model`` to every series and forecasts ``steps`` periods, with whole-count column."""
    return forecast.rounded_forecast(MODELS[model](series, steps, keys, period))


def compare(actual: DataFrame, predicted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Actual and predicted value of the same series and period side by side, prediction >= 0."""
    keys = list(keys)
    floor = predicted.select(*keys, "ds", F.greatest(F.col("yhat"), F.lit(0.0)).alias("yhat"))
    return actual.select(*keys, "ds", F.col("y").cast("double").alias("y")).join(floor, [*keys, "ds"])


def error_metrics(compared: DataFrame, keys: Sequence[str] = KEYS, digits: int | None = 2) -> DataFrame:
    """MAE, RMSE and MAPE (%); the MAPE denominator is the actual value but at least 1."""
    gap = F.abs(F.col("y") - F.col("yhat"))
    measures = {
        "mae": F.avg(gap),
        "rmse": F.sqrt(F.avg(gap * gap)),
        "mape": F.avg(gap / F.greatest(F.col("y"), F.lit(1.0))) * 100.0,
    }
    columns = [(F.bround(m, digits) if digits is not None else m).alias(name) for name, m in measures.items()]
    return compared.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_test"), *columns)


def _evaluate(split: DataFrame, model: str, horizon: int, keys: Sequence[str], period: str = "month") -> DataFrame:
    # Read twice, for fitting and for testing.
    split = saved_table(split, "split")
    predicted = MODELS[model](split.where("part = 'train'").drop("part"), horizon, keys, period)
    return compare(split.where("part = 'test'"), predicted, keys)


def holdout_metrics(
    series: DataFrame, model: str, horizon: int = 6, min_train: int = 0, keys: Sequence[str] = KEYS, period: str = "month"
) -> DataFrame:
    """Fits on all but the last ``horizon`` periods and scores the forecast of those."""
    return error_metrics(_evaluate(holdout_split(series, horizon, min_train, keys), model, horizon, keys, period), keys)


def rolling_metrics(
    series: DataFrame,
    model: str = "sarima_backtest",
    origins: Sequence[int] = ORIGINS,
    horizon: int = 6,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """One row per series and origin; every fold of every series is fitted in the same job."""
    fold_keys = [*keys, "origin"]
    compared = _evaluate(rolling_folds(series, origins, horizon, keys), model, horizon, fold_keys)
    return error_metrics(compared, fold_keys)


def average_metrics(folds: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return folds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_folds"), F.bround(F.avg("mae"), 2).alias("mae"), F.bround(F.avg("rmse"), 2).alias("rmse")
    )
