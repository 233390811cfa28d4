"""Repeatable exact splits: stratified train/test and k folds, without sorting a class.

Rows are ranked by the MD5 of their key and a seed. A row's side depends only on whether its hash
lies under its class's cut hash, so the rows themselves are never shuffled: one pass counts hashes
per class and prefix, a second looks inside the single prefix that holds each cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casecurve.session import saved_table

PREFIX = 3  # least hex digits: 4096 slices per class


def prefix_for(rows: int) -> int:
    """Hex digits that make about as many slices as a slice of all rows has hashes."""
    return max(PREFIX, math.ceil(math.log(max(1, math.isqrt(rows)), 16)))


def row_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def _cut_hashes(df: DataFrame, key: str, label: str | None, ranks: list[Column], seed: int) -> DataFrame:
    """``label``, ``cuts``: per class the hashes of its rows number ``ranks`` (1-based, of ``n``).

    A rank of 0 gives the empty string, which is below every hash. No label: one class for all.
    """
    class_of = F.col(label) if label else F.lit("all")
    hashed = df.select(class_of.alias("label"), row_hash(key, seed).alias("hash"))
    slice_of = F.substring("hash", 1, prefix_for(df.count()))
    slices = hashed.groupBy("label", slice_of.alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    in_class = Window.partitionBy("label")
    wanted = F.array(*[F.struct(F.lit(i).alias("cut"), r.cast("long").alias("rank")) for i, r in enumerate(ranks)])
    slices = (
        slices.withColumn("upto", F.sum("n").over(in_class.orderBy("slice")))
        .withColumn("before", F.col("upto") - F.col("n"))
        .withColumn("n", F.sum("n").over(in_class))
        .select("label", "slice", "before", "upto", F.explode(wanted).alias("w"))
        .select("label", "slice", "before", "upto", "w.cut", "w.rank")
    )
    slices = saved_table(slices.where("(rank > before and rank <= upto) or (rank <= 0 and before = 0)"), "cuts")

    upto_hash = Window.partitionBy("label", "cut").orderBy("hash")
    cuts = (
        hashed.withColumn("slice", slice_of)
        .join(slices, ["label", "slice"])
        .groupBy("label", "cut", "rank", "before", "hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("reached", F.col("before") + F.sum("n").over(upto_hash))
        .groupBy("label", "cut")
        .agg(F.coalesce(F.min(F.when((F.col("rank") > 0) & (F.col("reached") >= F.col("rank")), F.col("hash"))), F.lit("")).alias("hash"))
    )
    listed = cuts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("cut", "hash"))).alias("_c"))
    return saved_table(listed.select("label", F.transform("_c", lambda c: c["hash"]).alias("cuts")), "cuts")


def _with_cuts(df: DataFrame, key: str, label: str | None, ranks: list[Column], seed: int) -> DataFrame:
    """Adds each row's ``_hash`` and its class's ``cuts``."""
    cuts = _cut_hashes(df, key, label, ranks, seed)
    if label is None:
        cut = df.withColumn("cuts", cuts.select("cuts").scalar())
    else:
        cut = df.join(cuts.withColumnRenamed("label", "_label"), F.col(label) == F.col("_label")).drop("_label")
    return cut.withColumn("_hash", row_hash(key, seed))


def stratified_split(
    df: DataFrame, key: str, label: str, test_percent: int = 20, seed: int = 42
) -> DataFrame:
    """Adds ``part``: exactly ceil(n * percent / 100) rows of each class are ``test``.

    Rows without a label are left out. Copies of one key stay together, on the train or test side.
    """
    n_test = F.floor((F.col("n") * test_percent + 99) / 100)
    rows = _with_cuts(df, key, label, [n_test], seed)
    part = F.when(F.col("_hash") <= F.element_at("cuts", 1), "test").otherwise("train")
    return rows.withColumn("part", part).drop("cuts", "_hash")


def assign_folds(df: DataFrame, key: str, label: str | None = None, k: int = 5, seed: int = 42) -> DataFrame:
    """Adds ``fold`` 0..k-1 of sizes that differ by at most one, per class or over all rows."""
    ranks = [F.ceil(F.col("n") * i / k) for i in range(1, k)]
    cut = _with_cuts(df, key, label, ranks, seed)
    # One comparison per cut stays in generated code, which a lambda over the array would not.
    fold = sum(((F.col("_hash") > F.element_at("cuts", i)).cast("int") for i in range(1, k)), start=F.lit(0))
    return cut.withColumn("fold", fold).drop("cuts", "_hash")


def hash_split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds ``part`` from each row's own hash: no pass over the data, shares only approximate."""
    share = F.conv(F.substring(row_hash(key, seed), 1, 8), 16, 10).cast("double") / float(16**8)
    return df.withColumn("part", F.when(share < test_percent / 100, "test").otherwise("train"))
