"""Model inputs: class weights, standardised numbers and one-hot categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.session import saved_table

MAX_CATEGORIES = 1000


def with_class_weight(df: DataFrame, label: str, output: str = "weight") -> DataFrame:
    """Adds n / (k * n_c): every class gets the same total weight. Rows without a label are left out."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    counts = saved_table(counts, "weights")
    total = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = counts.select("_label", (total["n"] / (total["k"] * F.col("_n"))).alias(output))
    return df.join(weights, F.col(label) == F.col("_label")).drop("_label")


def standardised(df: DataFrame, columns: Sequence[str], statistics_from: DataFrame | None = None) -> DataFrame:
    """Columns as (x - mean) / population std; a constant column keeps its centred value."""
    source = statistics_from if statistics_from is not None else df
    fields = [s for c in columns for s in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))]
    stats = source.agg(F.struct(*fields)).scalar()
    return df.withColumns(
        {
            c: (F.col(c) - stats[f"{c}_mean"]) / F.when(stats[f"{c}_std"] > 0, stats[f"{c}_std"]).otherwise(F.lit(1.0))
            for c in columns
        }
    )


def categories(df: DataFrame, column: str, most: int = MAX_CATEGORIES) -> list[str]:
    """The sorted distinct values, as a list; each becomes a column, so more than ``most`` is an error."""
    found = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} categories")
    return [r[0] for r in found]


def kept_categories(values: Sequence[str]) -> list[str]:
    """Two categories need one column: the first is dropped."""
    return list(values[1:]) if len(values) == 2 else list(values)


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None, most: int = MAX_CATEGORIES) -> DataFrame:
    """Adds ``{column}_{value}`` 1/0 columns; unknown or missing values have zeros throughout."""
    values = list(values) if values is not None else categories(df, column, most)
    flags = {f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in kept_categories(values)}
    return df.withColumns(flags) if flags else df
