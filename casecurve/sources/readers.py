"""Scans: series, line lists and clinical tables from CSV, Parquet, ORC or JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casecurve.functions.dates import parsed_time
from casecurve.functions.numbers import lenient_double

FORMATS = ("csv", "parquet", "orc", "json")


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns as text, so that reading never infers or drops anything."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """One table. CSV has a header line and, without a schema, only text columns (nothing is
    inferred from the rows); JSON should be given a schema."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}, expected one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options = {"header": True, **options}
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def read_series(
    spark: SparkSession, path: str, series_id: str, fmt: str = "csv", strict: bool = True, date_format: str | None = None
) -> DataFrame:
    """A monthly series with columns ``ds, y``; rows missing either are dropped, no order is implied."""
    raw = read_table(spark, path, fmt, text_schema(["ds", "y"]) if fmt == "json" else None)
    return raw.select(
        F.lit(series_id).alias("series_id"),
        parsed_time(F.col("ds").cast("string"), strict, date_format).cast("date").alias("ds"),
        lenient_double(F.col("y")).alias("y"),
    ).na.drop(subset=["ds", "y"])


def read_line_list(
    spark: SparkSession,
    path: str,
    series_id: str,
    fmt: str = "csv",
    date: str = "Screening_Date",
    status: str = "Case_Status",
    strict: bool = True,
) -> DataFrame:
    """A case line list as ``series_id, event_ts, status``.

    ``strict`` raises on an unreadable date; otherwise such rows, and undated ones, are dropped.
    """
    raw = read_table(spark, path, fmt, text_schema([date, status]) if fmt == "json" else None)
    rows = raw.select(
        F.lit(series_id).alias("series_id"),
        parsed_time(F.col(date).cast("string"), strict).alias("event_ts"),
        F.col(status).alias("status"),
    )
    return rows if strict else rows.na.drop(subset=["event_ts"])


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Selects and renames columns; names with dots or spaces are taken literally."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def dropped(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(columns)])
