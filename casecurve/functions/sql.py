"""The risk expressions as SQL functions, for use in ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from casecurve.functions.risk import ALERT, ALERT_Z, CRITICAL, CRITICAL_Z, MIN_STD, NORMAL


def register_functions(spark: SparkSession) -> None:
    """Creates temporary SQL functions ``case_z(value, mean, std)`` and ``risk_grade(z)``."""
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION case_z(value DOUBLE, mean DOUBLE, std DOUBLE) RETURNS DOUBLE
        RETURN (value - mean) / CASE WHEN std > {MIN_STD}D AND NOT isnan(std) THEN std ELSE 1.0D END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION risk_grade(z DOUBLE) RETURNS STRING
        RETURN CASE WHEN z IS NULL OR isnan(z) THEN NULL WHEN z < {ALERT_Z}D THEN '{NORMAL}'
                    WHEN z < {CRITICAL_Z}D THEN '{ALERT}' ELSE '{CRITICAL}' END""")
