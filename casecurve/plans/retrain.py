"""Retraining everything: parameters of every series' forecast, hold-out scores, the classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.operators import classify, evaluate
from casecurve.operators.forecast import rounded_forecast
from casecurve.operators.series import KEYS
from casecurve.session import saved_table
from casecurve.sources import models

SERVICE_MODELS = ("holt_winters", "sarima")


@dataclass
class Retrained:
    """What a retraining run produced: stored parameters by model name, scores, and the classifier if one was trained."""

    params: dict[str, DataFrame]
    holdout: DataFrame
    classifier: classify.Classifier | None


def retrain_forecasts(
    series: DataFrame,
    folder: str,
    names: Sequence[str] = SERVICE_MODELS,
    keys: Sequence[str] = KEYS,
    period: str = "month",
    horizon: int = 6,
    min_train: int = 12,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Parameters of the named models, stored under ``folder`` and read back, and the models' hold-out scores.

    The stored model and the scored one are the same function, fitted to the whole series and to all but the
    last ``horizon`` periods.
    """
    series = saved_table(series, "series")
    params, lines = {}, []
    for name in names:
        fit = evaluate.halves(name).fit
        models.save_params(fit(series, keys, period), f"{folder}/{name}")
        params[name] = series.sparkSession.read.parquet(f"{folder}/{name}")
        scores = evaluate.holdout_metrics(series, name, horizon, min_train, keys, period)
        lines.append(scores.select(F.lit(name).alias("model"), "*"))
    return params, saved_table(reduce(DataFrame.unionByName, lines), "holdout")


def stored_forecast(
    spark: SparkSession, folder: str, name: str, steps: int = 6, keys: Sequence[str] = KEYS, period: str = "month"
) -> DataFrame:
    """The forecast of a model whose parameters ``retrain_forecasts`` stored, without the series."""
    params = spark.read.parquet(f"{folder}/{name}")
    return rounded_forecast(evaluate.halves(name).predict(params, steps, keys, period))


def retrain(
    series: DataFrame,
    records: DataFrame,
    folder: str,
    key: str,
    label: str,
    positive: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keys: Sequence[str] = KEYS,
    names: Sequence[str] = SERVICE_MODELS,
    period: str = "month",
    kind: str = "forest",
) -> Retrained:
    """Fits and stores the named forecast models and the classifier under ``folder``.

    Hold-out scores compare the forecast models on the last six periods of every series.
    """
    params, holdout = retrain_forecasts(series, folder, names, keys, period)
    fitted = classify.train_with_threshold(records, key, label, positive, numeric, categorical, kind)
    models.save_classifier(series.sparkSession, fitted, f"{folder}/classifier")
    return Retrained(params, holdout, fitted)
