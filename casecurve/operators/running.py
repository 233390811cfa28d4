"""Running totals over a globally ordered column, in parallel.

A window without partitions would run in one task. Here the order is cut into slices at approximate
quantiles, as many as the rows ask for; each slice is summed on its own and shifted by the total of the slices
before it. Those shifts are running totals themselves and are taken level by level: blocks of slices,
blocks of blocks, until one block is left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casecurve.session import saved_table

# A slice has at most half as many rows again, up to 65,536 slices; beyond 16 thousand million rows slices grow.
SLICE_ROWS = 250_000
MOST_SLICES = 1 << 16
# Totals that one window sums up.
BLOCK = 1 << 10


def _ordered(column: str, descending: bool):
    return F.col(column).desc() if descending else F.col(column).asc()


def offsets(totals: DataFrame, n: int, sums: Sequence[str], descending: bool, block: int = BLOCK) -> DataFrame:
    """``_slice`` and, as ``_{c}``, the sums over all slices before it; ``totals`` has ``_slice`` in 0..n-1 and the sums of each.

    No window has more than ``block`` rows.
    """
    before = Window.partitionBy("_block").orderBy(_ordered("_slice", descending)).rowsBetween(Window.unboundedPreceding, -1)
    blocked = totals.withColumn("_block", F.floor(F.col("_slice") / block).cast("int"))
    inner = blocked.select("_block", "_slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    if n <= block:
        return inner.drop("_block")
    by_block = blocked.groupBy(F.col("_block").alias("_slice")).agg(*[F.sum(c).alias(c) for c in sums])
    outer = offsets(by_block, -(-n // block), sums, descending, block)
    shifts = outer.select(F.col("_slice").alias("_block"), *[F.col(f"_{c}").alias(f"_shift_{c}") for c in sums])
    joined = inner.join(shifts, "_block")
    return joined.select("_slice", *[(F.col(f"_{c}") + F.col(f"_shift_{c}")).alias(f"_{c}") for c in sums])


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], descending: bool = True, slices: int | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Adds ``{c}_upto`` for each column: its sum over all rows up to and including this order value.

    ``df`` is read more than once and should be cheap to read (a saved table). The cut points affect only the
    balance of the slices, never the totals. Unless ``slices`` are given there is one for ``slice_rows`` rows.
    Rows of one order value stay in one slice: count them first if they may be very many.
    """
    wanted = slices or min(MOST_SLICES, max(1, -(-df.count() // slice_rows)))
    if wanted == 1:
        all_rows = Window.partitionBy(F.lit(0)).orderBy(_ordered(order, descending))
        return df.withColumns({f"{c}_upto": F.sum(c).over(all_rows) for c in sums})
    # Slices only need a monotone number; inside them rows are ordered by the value itself.
    df = df.withColumn("_by", F.col(order).cast("double"))
    points = df.approxQuantile("_by", [i / wanted for i in range(1, wanted)], 1 / (4 * wanted))
    inner = sorted({p for p in points if math.isfinite(p)})
    bounds = [-math.inf, *(inner or [0.0]), math.inf]
    cut = Bucketizer(splits=bounds, inputCol="_by", outputCol="_slice").transform(df)
    sliced = cut.withColumn("_slice", F.col("_slice").cast("int"))

    totals = sliced.groupBy("_slice").agg(*[F.sum(c).alias(c) for c in sums])
    if len(bounds) - 1 <= BLOCK:
        # A row for each slice, so at most BLOCK of them.
        shifted = F.broadcast(offsets(totals, len(bounds) - 1, sums, descending))
    else:
        # Several levels read the totals, and their size decides the join.
        shifted = saved_table(offsets(saved_table(totals, "slices"), len(bounds) - 1, sums, descending), "offsets")
    within = Window.partitionBy("_slice").orderBy(_ordered(order, descending))
    joined = sliced.join(shifted, "_slice")
    return joined.withColumns({f"{c}_upto": F.col(f"_{c}") + F.sum(c).over(within) for c in sums}).drop(
        "_slice", "_by", *[f"_{c}" for c in sums]
    )


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Adds ``position`` 0, 1, 2... by a unique numeric column, without a single-task sort."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"], descending=False)
    return counted.withColumn("position", F.col("_one_upto") - 1).drop("_one", "_one_upto")
