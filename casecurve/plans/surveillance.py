"""Composite surveillance plans: from a case line list to graded history, forecasts and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.functions.risk import ALERT, grade_rank
from casecurve.functions.text import alert_message
from casecurve.operators.baseline import global_baseline, seasonal_baseline
from casecurve.operators.evaluate import forecast_with
from casecurve.operators.risk import anomalies, assess_forecast, evaluate_counts, scan_history
from casecurve.operators.series import KEYS
from casecurve.session import saved_table
from casecurve.sources import stores

# Longest horizon of the summary and of a single forecast.
MAX_SUMMARY_STEPS, MAX_FORECAST_STEPS = 12, 24
# Fixed value: the z-score of a drill alert.
DRILL_Z = 2.35
# The model names stored with forecast records.
MODEL_NAMES = {"holt_winters": "Holt-Winters", "sarima": "SARIMA"}


@dataclass
class SurveillanceSummary:
    """The parts of a surveillance run."""

    baseline: DataFrame
    seasonal: DataFrame
    forecast: DataFrame
    alerts: DataFrame


def check_horizon(months: int, limit: int = MAX_FORECAST_STEPS) -> int:
    if not 1 <= months <= limit:
        raise ValueError(f"months must be between 1 and {limit}, got {months}")
    return months


def forecast_by_model(
    series: DataFrame, models: Mapping[str, str], months: int, default: str = "holt_winters", key: str = "series_id"
) -> DataFrame:
    """Forecasts with a model for each series: ``models`` names it by series, ``default`` is for all others.

    Every series is fitted once, by its own model; ``model`` keeps its name. ``series`` should be a saved table.
    """
    spark = series.sparkSession
    chosen = saved_table(spark.createDataFrame(list(models.items()), f"{key} string, model string"), "models")
    named = series.join(chosen, key, "left").withColumn("model", F.coalesce("model", F.lit(default)))
    out = None
    for model in sorted({*models.values(), default}):
        part = forecast_with(named.where(F.col("model") == model).drop("model"), model, months, [key])
        part = part.select(key, "ds", "step", "predicted_cases", F.lit(model).alias("model"))
        out = part if out is None else out.unionByName(part)
    return out


def graded_forecast(
    series: DataFrame, model: str | Mapping[str, str] = "holt_winters", months: int = 6, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Forecast of every series, graded against month-of-year levels.

    ``model`` is one for all series or a model by series, whose names the result then keeps in ``model``.
    The models and both baselines read the series, so it is saved first: the line list behind it is
    scanned once.
    """
    check_horizon(months)
    series = saved_table(series, "series")
    if isinstance(model, str):
        predicted = forecast_with(series, model, months, keys).select(*keys, "ds", "step", "predicted_cases")
    else:
        predicted = forecast_by_model(series, model, months)
    return assess_forecast(predicted, global_baseline(series, keys), seasonal_baseline(series, keys), keys)


def disease_forecast(series: DataFrame, series_id: str, model: str = "holt_winters", months: int = 6) -> DataFrame:
    """The graded forecast of one series; the choice of series reaches the scan of the line list."""
    return graded_forecast(series.where(F.col("series_id") == series_id), model, months)


def alert_rows(graded: DataFrame, region: str, style: str = "summary") -> DataFrame:
    """Alert records for the anomalous forecast rows (key column ``series_id``)."""
    return anomalies(graded).select(
        F.col("series_id").alias("disease"),
        F.lit(region).alias("region"),
        "risk_level",
        F.bround("z_score", 3).alias("z_score"),
        alert_message(F.col("series_id"), F.col("ds"), F.col("predicted_cases"), F.col("z_score"), style).alias("alert_message"),
        F.lit(False).alias("is_resolved"),
    )


def forecast_records(graded: DataFrame, model: str | None = None) -> DataFrame:
    """Forecast rows in the stored shape, under the name of the one model or of each row's own."""
    own = F.col("model") if "model" in graded.columns else F.lit(model)
    names = F.create_map(*[F.lit(x) for pair in MODEL_NAMES.items() for x in pair])
    return graded.select(
        F.col("series_id").alias("disease"),
        F.col("ds").alias("forecast_month"),
        "predicted_cases",
        F.bround("z_score", 3).alias("z_score"),
        "risk_level",
        F.bround("baseline_mean", 2).alias("baseline_mean"),
        F.bround("baseline_std", 2).alias("baseline_std"),
        F.coalesce(names[own], own).alias("model_name"),
    )


def summarise(
    series: DataFrame, months: int = 6, model: str | Mapping[str, str] = "holt_winters", region: str = "Surveillance Region"
) -> SurveillanceSummary:
    """Baselines, graded forecasts and alerts of every series; the forecast is computed here, once."""
    check_horizon(months, MAX_SUMMARY_STEPS)
    series = saved_table(series, "series")
    graded = saved_table(graded_forecast(series, model, months), "forecast")
    return SurveillanceSummary(global_baseline(series), seasonal_baseline(series), graded, alert_rows(graded, region))


def store_summary(summary: SurveillanceSummary, model: str | None, forecasts_path: str, alerts_path: str) -> None:
    """Appends all forecasts and alerts of a run, one write each."""
    stores.append(forecast_records(summary.forecast, model), forecasts_path, stores.FORECASTS_SCHEMA)
    stores.append(summary.alerts, alerts_path, stores.ALERTS_SCHEMA)


def anomaly_table(*series: DataFrame) -> DataFrame:
    """Anomalous periods of several groups of series in one table, sorted by date and series."""
    graded = [scan_history(s) for s in series]
    combined = graded[0]
    for other in graded[1:]:
        combined = combined.unionByName(other)
    return anomalies(combined).orderBy("ds", "series_id")


def current_status(series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Grade of the latest count of every series against its overall level."""
    latest = global_baseline(series, keys).select(*keys, F.col("last_ds").alias("ds"), F.col("last_cases").alias("cases"), "mean", "std")
    return evaluate_counts(latest)


def alerts_or_drill(
    alerts: DataFrame, disease: str = "Drill", region: str = "All regions", z: float = DRILL_Z
) -> DataFrame:
    """The alerts, or one drill alert for readiness checks when there is none."""
    alerts = saved_table(alerts, "alerts")
    drill = (
        alerts.groupBy()
        .agg(F.count(F.lit(1)).alias("_n"))
        .where("_n = 0")
        .select(
            F.lit(disease).alias("disease"),
            F.lit(region).alias("region"),
            F.lit(ALERT).alias("risk_level"),
            F.lit(z).alias("z_score"),
            F.lit("Readiness drill: no natural alert in the forecast window.").alias("alert_message"),
            F.lit(False).alias("is_resolved"),
        )
    )
    return alerts.unionByName(drill)


def worst_first(alerts: DataFrame, n: int = 1, order: Sequence[str] = ("ds", "series_id")) -> DataFrame:
    """The first Critical alert, else the first alert; ``n`` rows in that order."""
    return alerts.orderBy(grade_rank(F.col("risk_level")), *order).limit(n)


def dashboard_tiles(intakes: DataFrame, graded: DataFrame) -> DataFrame:
    """Long table tile, value: logged intakes, next forecast per series, active alerts."""
    graded = saved_table(graded, "forecast")
    logged = intakes.agg(F.count(F.lit(1)).alias("value")).select(F.lit("intakes_logged").alias("tile"), "value")
    following = graded.groupBy("series_id").agg(F.min_by("predicted_cases", "ds").alias("value")).select(
        F.concat(F.lit("next_forecast:"), F.col("series_id")).alias("tile"), "value"
    )
    active = graded.agg(F.count_if(F.col("is_anomaly")).alias("value")).select(F.lit("active_alerts").alias("tile"), "value")
    return logged.unionByName(following).unionByName(active)
