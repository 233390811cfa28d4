"""Grading observations and forecasts against baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casecurve.functions.risk import ALERT_Z, CRITICAL_Z, is_anomalous, risk_grade, usable_std, z_score
from casecurve.operators.series import KEYS


def _graded(df: DataFrame, raw_z: str, grade_on: str, alert: float, critical: float) -> DataFrame:
    """Adds z_score (2 decimals), risk_level and is_anomaly from an unrounded z column."""
    graded = F.col("z_score") if grade_on == "rounded" else F.col(raw_z)
    return (
        df.withColumn("z_score", F.bround(raw_z, 2))
        .withColumn("risk_level", risk_grade(graded, alert, critical))
        .withColumn("is_anomaly", is_anomalous(F.col("risk_level")))
        .drop(raw_z)
    )


def scan_history(
    series: DataFrame,
    keys: Sequence[str] = KEYS,
    grade_on: str = "rounded",
    alert: float = ALERT_Z,
    critical: float = CRITICAL_Z,
) -> DataFrame:
    """Grades every period of every series against that series' own mean and spread.

    The level comes from a window on the series key, the partitioning the series already has.
    """
    whole = Window.partitionBy(*keys)
    levelled = series.withColumn("_mean", F.avg("y").over(whole)).withColumn("_std", F.stddev_samp("y").over(whole))
    rows = levelled.select(
        *keys,
        "ds",
        "y",
        F.bround("_mean", 1).alias("baseline_mean"),
        F.bround(usable_std(F.col("_std")), 1).alias("baseline_std"),
        z_score(F.col("y"), F.col("_mean"), F.col("_std")).alias("_z"),
    )
    return _graded(rows, "_z", grade_on, alert, critical)


def assess_forecast(
    forecast: DataFrame,
    baseline: DataFrame,
    seasonal: DataFrame | None = None,
    keys: Sequence[str] = KEYS,
    grade_on: str = "rounded",
    alert: float = ALERT_Z,
    critical: float = CRITICAL_Z,
) -> DataFrame:
    """Grades forecast rows (``ds``, ``predicted_cases``) against the month's level.

    A series or month missing from ``seasonal`` uses the overall ``baseline``. Both sides hold at
    most a few rows per series; the joins are left to the optimizer.
    """
    keys = list(keys)
    overall = baseline.select(*keys, F.col("mean").alias("_gmean"), F.col("std").alias("_gstd"))
    rows = forecast.join(overall, keys, "left")
    if seasonal is None:
        mean, std = F.col("_gmean"), F.col("_gstd")
    else:
        monthly = seasonal.select(*keys, F.col("month").alias("_month"), F.col("mean").alias("_mmean"), F.col("std").alias("_mstd"))
        rows = rows.withColumn("_month", F.month("ds")).join(monthly, [*keys, "_month"], "left")
        mean, std = F.coalesce("_mmean", "_gmean"), F.coalesce("_mstd", "_gstd")
    rows = (
        rows.withColumn("baseline_mean", F.bround(mean, 1))
        .withColumn("baseline_std", F.bround(usable_std(std), 1))
        .withColumn("_z", z_score(F.col("predicted_cases"), mean, std))
    )
    helpers = ["_gmean", "_gstd", "_month", "_mmean", "_mstd"]
    return _graded(rows.drop(*helpers), "_z", grade_on, alert, critical)


def evaluate_counts(
    df: DataFrame,
    cases: str = "cases",
    mean: str = "mean",
    std: str = "std",
    alert: float = ALERT_Z,
    critical: float = CRITICAL_Z,
) -> DataFrame:
    """Grades one count per row against the row's own baseline; the grade uses the unrounded z."""
    others = [c for c in df.columns if c not in (cases, mean, std)]
    rows = df.select(
        *others,
        F.bround(F.col(cases).cast("double"), 1).alias("cases"),
        F.bround(mean, 1).alias("baseline_mean"),
        F.bround(usable_std(F.col(std)), 1).alias("baseline_std"),
        z_score(F.col(cases), F.col(mean), F.col(std)).alias("_z"),
    )
    return _graded(rows, "_z", "raw", alert, critical)


def anomalies(graded: DataFrame) -> DataFrame:
    return graded.where("is_anomaly")
