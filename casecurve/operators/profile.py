"""Data profile: counts, shares, missing values, duplicates, spreads and simple fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.operators.quantiles import summarise_values
from casecurve.operators.splits import row_hash


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """How often each value occurs, missing ones included, most frequent first (ties by value)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.col("value").asc_nulls_first())
    return ordered.limit(top) if top is not None else ordered


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of every present value in percent (2 decimals)."""
    present = df.where(F.col(column).isNotNull())
    total = present.select(F.count(F.lit(1))).scalar()
    counts = present.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("value", F.bround(F.col("n") * 100.0 / total, 2).alias("percent"))


def _is_missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if kind in ("double", "float") else missing


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column``, ``n_missing`` for each column, from one scan."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(_is_missing(df, c)).alias(f"_{i}") for i, c in enumerate(columns)])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_missing")) for i, c in enumerate(columns)])
    return counted.select(F.explode(cells).alias("_c")).select("_c.*")


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None, digest: bool = False) -> DataFrame:
    """Rows that repeat an earlier one, as ``n_rows``, ``n_duplicates``.

    Copies collapse before the shuffle, so one value repeated by a third of the rows is no hot spot.
    ``digest`` groups by the SHA-256 of the text columns, for long texts that should not travel.
    """
    columns = list(columns or df.columns)
    if digest:
        kinds = dict(df.dtypes)
        keys = [F.sha2(F.col(c), 256).alias(c) if kinds[c] == "string" else F.col(c) for c in columns]
    else:
        keys = [F.col(c) for c in columns]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def describe_by_class(df: DataFrame, label: str, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Count, mean, std, min, quartiles and max of every column per class (2 decimals)."""
    summary = summarise_values(df, columns, (0.25, 0.5, 0.75), [label], accuracy)
    quartiles = [F.bround(F.element_at("quantiles", i + 1), 2).alias(q) for i, q in enumerate(("q25", "q50", "q75"))]
    moments = [F.bround(c, 2).alias(c) for c in ("mean", "std", "min", "max")]
    return summary.select(label, "column", "count", *moments, *quartiles)


def range_by_class(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of every column per class."""
    return df.groupBy(label).agg(
        *[f(c).alias(f"{c}_{name}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    )


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str], digits: int = 4) -> DataFrame:
    """Least-squares line of y on x per group, with its R²."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.bround(F.regr_slope(y, x), digits).alias("slope"),
        F.bround(F.regr_intercept(y, x), digits).alias("intercept"),
        F.bround(F.regr_r2(y, x), digits).alias("r2"),
    )


def shape(df: DataFrame) -> DataFrame:
    """Row and column count plus column types, one row per column."""
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(t).alias("dtype")) for i, (c, t) in enumerate(df.dtypes)])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.explode(cells).alias("_c")).select("n_rows", "_c.*")


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def final_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def sample_rows(df: DataFrame, key: str, n: int = 5, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows by the hash of their key: a repeatable draw, each task offering n."""
    return df.orderBy(row_hash(key, seed), key).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row count of every table."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = counted[0]
    for other in counted[1:]:
        out = out.unionByName(other)
    return out
