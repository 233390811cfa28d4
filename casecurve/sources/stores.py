"""Stored result tables: appends, newest-first reads and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The number of rows a newest-first read may ask for.
LATEST_RANGE = (1, 50)

# Columns of the stored tables.
INTAKES_SCHEMA = (
    "patient_code string, age int, gender string, fever_duration_days int, skin_manifestation boolean, "
    "predicted_disease string, confidence_score double, center_id string, doctor_confirmed_disease string, "
    "created_at timestamp"
)
FORECASTS_SCHEMA = (
    "disease string, forecast_month date, predicted_cases bigint, z_score double, risk_level string, "
    "baseline_mean double, baseline_std double, model_name string"
)
ALERTS_SCHEMA = (
    "disease string, region string, risk_level string, z_score double, alert_message string, "
    "is_resolved boolean, created_at timestamp"
)
CENTERS_SCHEMA = "id string, name string, city string, district string, latitude double, longitude double"


def shaped(df: DataFrame, schema: str) -> DataFrame:
    """The columns of ``schema`` in order and type; absent optional ones are null, the time is now."""
    fields = T.StructType.fromDDL(schema).fields
    columns = []
    for f in fields:
        if f.name in df.columns:
            column = F.col(f.name)
        elif f.name == "created_at":
            column = F.current_timestamp()
        else:
            column = F.lit(None)
        columns.append(column.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def append(df: DataFrame, path: str, schema: str) -> None:
    """Adds all rows in one write."""
    shaped(df, schema).write.mode("append").parquet(path)


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def intake_records(screened: DataFrame) -> DataFrame:
    """Screened intakes in the stored shape: whole ages and durations, confidence to 4 decimals."""
    optional = [c for c in ("center_id", "doctor_confirmed_disease") if c in screened.columns]
    return screened.select(
        "patient_code",
        F.col("age").cast("int").alias("age"),
        "gender",
        F.col("fever_duration_days").cast("int").alias("fever_duration_days"),
        F.col("skin_manifestation").cast("boolean").alias("skin_manifestation"),
        "predicted_disease",
        F.bround("confidence", 4).alias("confidence_score"),
        *[F.nullif(F.col(c), F.lit("")).alias(c) for c in optional],
    )


def latest(df: DataFrame, n: int = 10, ts: str = "created_at", key: str | None = None) -> DataFrame:
    """The newest ``n`` rows, ties by key."""
    low, high = LATEST_RANGE
    if not low <= n <= high:
        raise ValueError(f"limit must be between {low} and {high}, got {n}")
    return df.orderBy(F.desc(ts), *([key] if key else [])).limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
