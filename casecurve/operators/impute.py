"""Filling missing values from statistics of the same or another table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.operators.quantiles import medians


def _filled(df: DataFrame, columns: Sequence[str], fill: Column) -> DataFrame:
    """Replaces null and NaN from a one-row struct with a field per column."""
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), fill[c]) for c in columns})


def fill_median(df: DataFrame, columns: Sequence[str], statistics_from: DataFrame | None = None) -> DataFrame:
    """Missing numbers become the column's exact median."""
    found = medians(statistics_from if statistics_from is not None else df, columns)
    one_row = found.agg(F.struct(*[F.max(F.when(F.col("column") == c, F.col("median"))).alias(c) for c in columns]))
    return _filled(df, columns, one_row.scalar())


def fill_mean(df: DataFrame, columns: Sequence[str], statistics_from: DataFrame | None = None) -> DataFrame:
    """Missing numbers become the column's mean, of another table if given (train means into test)."""
    source = statistics_from if statistics_from is not None else df
    means = source.agg(F.struct(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns]))
    return _filled(df, columns, means.scalar())


def fill_mode(df: DataFrame, column: str, statistics_from: DataFrame | None = None) -> DataFrame:
    """Missing categories become the most frequent one; ties go to the smallest value."""
    source = statistics_from if statistics_from is not None else df
    counts = source.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.orderBy(F.desc("_n"), column).limit(1).select(column)
    return df.withColumn(column, F.coalesce(F.col(column), top.scalar()))
