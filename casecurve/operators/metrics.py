"""Classification metrics as aggregates: confusion, reports, curves and areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.operators.running import running_totals
from casecurve.session import saved_table


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, 0 where the denominator is 0."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, labels: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts in the given label order, zeros included: ``position, actual``, one column per label."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(a).alias("actual"),
            *[F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"predicted_{b}") for b in labels],
        )
        for i, a in enumerate(labels)
    ]
    return df.agg(F.array(*cells).alias("_rows")).select(F.explode("_rows").alias("_r")).select("_r.*")


def class_scores(
    df: DataFrame, label: str = "label", prediction: str = "prediction", groups: Sequence[str] = ()
) -> DataFrame:
    """Per class: support, predicted, hits, precision, recall, f1 (unrounded).

    Rows without a label cannot be judged and are left out, as in every score here. Rows are reduced to
    (label, prediction) counts first; both roles of a class come from one further aggregation of those counts.
    """
    pairs = df.where(F.col(label).isNotNull()).groupBy(*groups, F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("_l").alias("class"), F.col("_n").alias("s"), F.lit(0).cast("long").alias("p"), hit.cast("long").alias("h")),
        F.struct(F.col("_p").alias("class"), F.lit(0).cast("long").alias("s"), F.col("_n").alias("p"), F.lit(0).cast("long").alias("h")),
    )
    sums = (
        pairs.select(*groups, F.explode(roles).alias("_r"))
        .where("_r.class IS NOT NULL")
        .groupBy(*groups, F.col("_r.class").alias("class"))
        .agg(F.sum("_r.s").alias("support"), F.sum("_r.p").alias("predicted"), F.sum("_r.h").alias("hits"))
    )
    return (
        sums.withColumn("precision", _ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(2.0 * F.col("hits"), F.col("support") + F.col("predicted")))
    )


def overall_scores(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: str | None = None,
    groups: Sequence[str] = (), digits: int = 4,
) -> DataFrame:
    """Accuracy, balanced accuracy, macro F1 and, if asked, precision/recall/F1 of one class."""
    scores = class_scores(df, label, prediction, groups)
    measures = {
        "accuracy": F.sum("hits") / F.sum("support"),
        "balanced_accuracy": F.avg(F.when(F.col("support") > 0, F.col("recall"))),
        "macro_f1": F.avg("f1"),
    }
    if positive is not None:
        for m in ("precision", "recall", "f1"):
            measures[f"positive_{m}"] = F.coalesce(F.max(F.when(F.col("class") == positive, F.col(m))), F.lit(0.0))
    return scores.groupBy(*groups).agg(*[F.bround(m, digits).alias(n) for n, m in measures.items()])


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 4) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    scores = class_scores(df, label, prediction)
    names = ["precision", "recall", "f1"]
    per_class = scores.select(F.col("class").cast("string").alias("class"), *names, "support")
    total = F.sum("support")
    hit_rate = F.sum("hits") / total
    summary = scores.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[hit_rate.alias(n) for n in names], total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[(F.sum(F.col(n) * F.col("support")) / total).alias(n) for n in names],
                total.alias("support"),
            ),
        ).alias("_rows")
    ).select(F.explode("_rows").alias("_r")).select("_r.*")
    rows = per_class.unionByName(summary)
    return rows.select("class", *[F.bround(n, digits).alias(n) for n in names], "support")


# -- score curves -------------------------------------------------------------------------------


def _score_counts(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """Distinct scores with their positives and negatives, saved once for the passes that follow."""
    counts = df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    return saved_table(counts, "scores")


def _curve(counts: DataFrame) -> DataFrame:
    """Per distinct score, counted from the highest down: pos, neg, pos_upto, neg_upto."""
    return running_totals(counts, "score", ["pos", "neg"])


def precision_recall_curve(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """``threshold, precision, recall, f1`` for each distinct score."""
    counts = _score_counts(df, score, positive)
    positives = counts.agg(F.sum("pos")).scalar()
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    # Without any positive row every threshold recalls everything there is.
    recall = F.when(positives > 0, F.col("pos_upto") / positives).otherwise(F.lit(1.0))
    return _curve(counts).select(
        F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall")
    ).withColumn("f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-10))


def best_threshold(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """The lowest score with the highest F1, with that F1."""
    curve = precision_recall_curve(df, score, positive)
    best = F.max_by("threshold", F.struct("f1", -F.col("threshold")))
    return curve.agg(best.alias("threshold"), F.max("f1").alias("f1"))


def score_areas(df: DataFrame, score: str, positive: Column, digits: int = 4) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision."""
    curve = _curve(_score_counts(df, score, positive))
    n_pos, n_neg = F.max("pos_upto").cast("double"), F.max("neg_upto").cast("double")
    # Negatives scored lower = all negatives - those scored at least as high.
    above = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") / 2.0))
    auc = 1.0 - above / F.when((n_pos > 0) & (n_neg > 0), n_pos * n_neg)
    precision = F.sum(F.col("pos") * F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto")))
    return curve.agg(
        F.bround(auc, digits).alias("roc_auc"),
        F.bround(precision / F.when(n_pos > 0, n_pos), digits).alias("average_precision"),
        F.max("pos_upto").alias("n_positive"),
        F.max("neg_upto").alias("n_negative"),
    )
