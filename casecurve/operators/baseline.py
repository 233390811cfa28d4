"""Reference levels of a series: overall and per month of year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.risk import MIN_STD
from casecurve.operators.series import KEYS


def global_baseline(series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean and sample standard deviation (1 decimal), length, last period and its count."""
    return series.groupBy(*keys).agg(
        F.bround(F.avg("y"), 1).alias("mean"),
        F.bround(F.stddev_samp("y"), 1).alias("std"),
        F.count("y").alias("total_periods"),
        F.max("ds").alias("last_ds"),
        F.max_by("y", "ds").cast("long").alias("last_cases"),
    )


def _spread_or_share(std: Column, mean: Column, n: Column | None = None) -> Column:
    """The spread where it is known and not zero, else a quarter of the mean, at least 1."""
    known = std > MIN_STD
    if n is not None:
        known = (n > 1) & known
    return F.when(known, std).otherwise(F.greatest(mean * 0.25, F.lit(1.0)))


def seasonal_baseline(series: DataFrame, keys: Sequence[str] = KEYS, fallback: str = "service") -> DataFrame:
    """Twelve rows per series: ``month``, ``n``, ``mean``, ``std`` (1 decimal).

    ``fallback="service"``: a month with one value or no spread gets max(mean / 4, 1).
    ``fallback="trainer"``: a month with one value gets a fifth of its mean, a zero spread stays.
    A month never seen takes the series' overall level under both rules.
    All months come from one aggregation per series; no join back to the series is needed.
    """
    month = F.month("ds")
    in_month = [F.when(month == m, F.col("y")) for m in range(1, 13)]
    per_month = [
        F.struct(
            F.lit(m).alias("month"),
            F.count(y).alias("n"),
            F.avg(y).alias("mean"),
            F.stddev_samp(y).alias("std"),
        )
        for m, y in enumerate(in_month, start=1)
    ]
    levels = series.groupBy(*keys).agg(
        F.avg("y").alias("_mean"), F.stddev_samp("y").alias("_std"), F.array(*per_month).alias("_months")
    )
    rows = levels.select(*keys, "_mean", "_std", F.explode("_months").alias("_m")).select(*keys, "_mean", "_std", "_m.*")
    if fallback == "trainer":
        seen = F.when(F.col("n") > 1, F.col("std")).otherwise(F.col("mean") * 0.2)
        unseen = F.col("_std")
    else:
        seen = _spread_or_share(F.col("std"), F.col("mean"), F.col("n"))
        unseen = _spread_or_share(F.col("_std"), F.col("_mean"))
    present = F.col("n") > 0
    return rows.select(
        *keys,
        "month",
        "n",
        F.bround(F.when(present, F.col("mean")).otherwise(F.col("_mean")), 1).alias("mean"),
        F.bround(F.when(present, seen).otherwise(unseen), 1).alias("std"),
    )


def seasonal_map(seasonal: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The twelve rows of a series as one map month → (mean, std)."""
    entry = F.struct(F.col("month"), F.struct("mean", "std"))
    return seasonal.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("seasonal"))
