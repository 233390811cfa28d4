"""Exact quantiles without sorting or collecting a whole group.

One pass brackets each wanted rank with approximate percentiles of guaranteed rank error; a second
pass counts rows by value inside the brackets and in one lump in each gap between them. Only the
brackets' distinct values are sorted, about 6/accuracy of a group per quantile. The accuracy grows with
the square root of the rows, so a group that holds any share of n rows sorts some sqrt(n) values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casecurve.functions.numbers import lenient_double
from casecurve.session import saved_table


def long_values(df: DataFrame, columns: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """One row per present number: groups, ``column``, ``value``. Unreadable text is missing; missing groups are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), lenient_double(F.col(c)).alias("value")) for c in columns])
    rows = df.select(*groups, F.explode(cells).alias("_cell")).select(*groups, "_cell.column", "_cell.value")
    present = F.col("value").isNotNull()
    for g in groups:
        present = present & F.col(g).isNotNull()
    return rows.where(present)


def _summaries(values: DataFrame, keys: list[str], probs: Sequence[float], accuracy: int) -> DataFrame:
    """Moments per key and value intervals certain to hold the wanted ranks."""
    margin = 3.0 / accuracy
    points = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    # Below this size the margin is narrower than a few ranks, so the whole range is one bracket.
    small = F.col("count") <= 4 * accuracy
    rows = values.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.percentile_approx("value", points, accuracy).alias("_points"),
    )
    n = len(probs)
    # Plain columns rather than arrays keep the second pass in generated code.
    lows = {f"_low{i}": F.when(small, F.col("min")).otherwise(F.col("_points")[i]) for i in range(n)}
    highs = {f"_high{i}": F.when(small, F.col("max")).otherwise(F.col("_points")[n + i]) for i in range(n)}
    return rows.withColumns({**lows, **highs}).drop("_points")


def accuracy_for(df: DataFrame) -> int:
    """The wanted rank accuracy for as many rows as ``df`` has."""
    return min(max(10_000, math.isqrt(df.count())), 1_000_000)


def summarise_values(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    groups: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Per group and column: count, mean, std, min, max and ``quantiles`` (linear interpolation)."""
    accuracy = accuracy or accuracy_for(df)
    keys = [*groups, "column"]
    values = long_values(df, columns, groups)
    summaries = saved_table(_summaries(values, keys, probs, accuracy), "quantiles")

    value = F.col("value")
    brackets = [(F.col(f"_low{i}"), F.col(f"_high{i}")) for i in range(len(probs))]
    names = [f"_{side}{i}" for i in range(len(probs)) for side in ("low", "high")]
    inside = reduce(or_, [(low <= value) & (value <= high) for low, high in brackets])
    # A value in a gap stands for all of that gap, under the end of the bracket before it.
    ends = [F.when(high < value, high) for _, high in brackets]
    counted = (
        values.join(summaries.select(*keys, *names), keys)
        .where(value <= F.greatest(*[high for _, high in brackets], F.lit(float("-inf"))))
        .select(
            *keys,
            F.when(inside, value).otherwise(F.greatest(*ends, F.lit(None).cast("double"))).alias("key"),
            (~inside).alias("in_gap"),
        )
        .groupBy(*keys, "key", "in_gap")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy(*keys).orderBy(F.col("key").asc_nulls_first(), "in_gap")
    ranked = counted.withColumn("_upto", F.sum("n").over(upto)).join(summaries.select(*keys, "count"), keys)

    def at(rank: Column) -> Column:
        """The value of that rank (from 0); landing in a gap would be an error."""
        row = F.min(F.when(F.col("_upto") > rank, F.struct("_upto", "key", "in_gap")))
        missed = F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
        return F.when(row["in_gap"], missed).otherwise(row["key"])

    quantiles = []
    for p in probs:
        position = (F.col("count") - 1) * float(p)
        share = F.first(position) - F.floor(F.first(position))
        lower, upper = at(F.floor(position)), at(F.ceil(position))
        quantiles.append(lower + share * (upper - lower))
    picked = ranked.groupBy(*keys).agg(F.array(*quantiles).alias("quantiles"))
    return summaries.drop(*names).join(picked, keys)


def medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """``column``, ``median``: the exact median of every column."""
    summary = summarise_values(df, columns, (0.5,), accuracy=accuracy)
    return summary.select("column", F.element_at("quantiles", 1).alias("median"))
