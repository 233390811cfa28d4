"""Gaussian naive Bayes as aggregates and column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.session import saved_table

# Fixed value: share of the largest variance added to every variance.
SMOOTHING = 1e-9


def _with_floor(levels: DataFrame, spreads: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Adds the smoothing floor, per group or for all."""
    if groups:
        return levels.join(spreads, list(groups))
    return levels.withColumn("_floor", spreads.scalar())


def fit_gaussian_nb(df: DataFrame, features: Sequence[Column], label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """One row per class (and group): ``label, log_prior, means, variances``."""
    def aggregates(f):
        return F.array(*[f(x) for x in features])

    df = df.where(F.col(label).isNotNull())
    floor = (SMOOTHING * F.array_max(aggregates(F.var_pop))).alias("_floor")
    levels = df.groupBy(*groups, F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("_n"), aggregates(F.avg).alias("means"), aggregates(F.var_pop).alias("_vars")
    )
    spreads = df.groupBy(*groups).agg(floor) if groups else df.agg(floor)
    totals = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_total"))
    rows = _with_floor(levels, spreads, groups)
    rows = rows.join(totals, list(groups)) if groups else rows.withColumn("_total", totals.scalar())
    return rows.select(
        *groups,
        "label",
        F.log(F.col("_n") / F.col("_total")).alias("log_prior"),
        "means",
        F.transform("_vars", lambda v: v + F.col("_floor")).alias("variances"),
    )


def _log_joint(model: Column, x: Column) -> Column:
    """log prior + sum of the feature log densities, what does not depend on the row summed up before."""
    gaps = F.zip_with(x, model["means"], lambda value, m: (value - m) * (value - m))
    per_feature = F.zip_with(gaps, model["variances"], lambda gap, v: gap / v)
    return model["log_norm"] - 0.5 * F.aggregate(per_feature, F.lit(0.0), lambda a, b: a + b)


def score_gaussian_nb(df: DataFrame, params: DataFrame, features: Sequence[Column], group: str | None = None) -> DataFrame:
    """Adds ``prediction`` and ``log_joint`` of the most likely class (ties to the larger label).

    Every row meets the parameters of all classes (of its group). They are one value per group, saved, so
    that its size decides how it reaches the rows.
    """
    with_norm = params.withColumn("log_norm", F.col("log_prior") - 0.5 * F.aggregate("variances", F.lit(0.0), lambda a, v: a + F.log(2.0 * math.pi * v)))
    held = F.collect_list(F.struct(*with_norm.columns)).alias("_models")
    # The feature array and the models become columns first, so that lambdas do not build them anew.
    if group is None:
        models = saved_table(with_norm.agg(held), "bayes")
        met = df.withColumn("_models", models.scalar())
    else:
        models = saved_table(with_norm.groupBy(F.col(group).alias("_group")).agg(held), "bayes")
        met = df.join(models, F.col(group) == F.col("_group"), "left").drop("_group")
    met = met.withColumn("_x", F.array(*features))
    scored = F.transform("_models", lambda m: F.struct(_log_joint(m, F.col("_x")).alias("log_joint"), m["label"].alias("label")))
    return met.withColumn("_best", F.array_max(scored)).select(
        *df.columns, F.col("_best.label").alias("prediction"), F.col("_best.log_joint").alias("log_joint")
    )


def cross_validated_nb(df: DataFrame, features: Sequence[Column], label: str, fold: str = "fold", k: int = 10) -> DataFrame:
    """Out-of-fold predictions of all folds in one job.

    Counts, means and squared deviations per fold and class are taken once; those of the other folds
    are merged for each fold. Rows are not copied and only class statistics move.
    """
    kept = df.where(F.col(label).isNotNull())
    moments = [F.struct(F.count(x).alias("n"), F.avg(x).alias("m"), F.var_pop(x).alias("v")) for x in features]
    stats = saved_table(kept.groupBy(F.col(fold).alias("_fold"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("_n"), F.array(*moments).alias("_s")), "folds")
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: i != F.col("_fold"))
    spread = stats.withColumn("_for", F.explode(others))

    def merged(*keys: str) -> DataFrame:
        """Means and variances over the folds that are not held out."""
        cells = spread.select("_for", "label", F.posexplode("_s").alias("_i", "_s")).where("_s.n > 0")
        sums = cells.groupBy(*keys, "_i").agg(
            F.sum("_s.n").alias("n"),
            F.sum(F.col("_s.n") * F.col("_s.m")).alias("s"),
            F.collect_list("_s").alias("_all"),
        ).withColumn("mean", F.col("s") / F.col("n"))
        squares = F.aggregate(
            "_all", F.lit(0.0), lambda a, p: a + p["n"] * (p["v"] + (p["m"] - F.col("mean")) * (p["m"] - F.col("mean")))
        )
        placed = F.struct("_i", "mean", (squares / F.col("n")).alias("variance"))
        return sums.groupBy(*keys).agg(F.array_sort(F.collect_list(placed)).alias("_p"))

    floor = merged("_for").select("_for", (SMOOTHING * F.array_max(F.transform("_p", lambda p: p["variance"]))).alias("_floor"))
    counts = spread.groupBy("_for", "label").agg(F.sum("_n").alias("_n"))
    totals = counts.groupBy("_for").agg(F.sum("_n").alias("_total"))
    params = merged("_for", "label").join(counts, ["_for", "label"]).join(totals, "_for").join(floor, "_for").select(
        F.col("_for").alias(fold),
        "label",
        F.log(F.col("_n") / F.col("_total")).alias("log_prior"),
        F.transform("_p", lambda p: p["mean"]).alias("means"),
        F.transform("_p", lambda p: p["variance"] + F.col("_floor")).alias("variances"),
    )
    return score_gaussian_nb(df, params, features, group=fold)
