"""Z-score and risk-grade expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade boundaries and the smallest usable standard deviation.
ALERT_Z = 2.0
CRITICAL_Z = 3.0
MIN_STD = 1e-6
NORMAL, ALERT, CRITICAL = "Normal", "Alert", "Critical"


def usable_std(std: Column) -> Column:
    """The standard deviation, or 1.0 where it is missing or practically zero."""
    return F.when((std > MIN_STD) & ~F.isnan(std), std).otherwise(F.lit(1.0))


def z_score(value: Column, mean: Column, std: Column) -> Column:
    return (value - mean) / usable_std(std)


def risk_grade(z: Column, alert: float = ALERT_Z, critical: float = CRITICAL_Z) -> Column:
    """Normal below ``alert``, Alert below ``critical``, else Critical; a missing z has no grade."""
    return (
        F.when(z.isNull() | F.isnan(z), F.lit(None).cast("string"))
        .when(z < alert, NORMAL)
        .when(z < critical, ALERT)
        .otherwise(CRITICAL)
    )


def is_anomalous(grade: Column) -> Column:
    return F.coalesce(grade.isin(ALERT, CRITICAL), F.lit(False))


def grade_rank(grade: Column) -> Column:
    """0 for Critical, 1 for the other grades: the order in which a worst alert is picked."""
    return F.when(F.lower(grade) == "critical", 0).otherwise(1)
