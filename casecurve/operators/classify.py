"""Patient classifiers: preprocessing, training, thresholds and scoring with Spark ML.

Preprocessing is one SQL projection with the training statistics as literals, so it is stored and
streamed with the model: median and mode imputation, (x - mean) / population std, and 1/0 columns
per category with the first of two dropped and unknown values all zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.numbers import lenient_double
from casecurve.operators.features import MAX_CATEGORIES, kept_categories
from casecurve.operators.forest import GrownForest, grow_forest
from casecurve.operators.kernel_svm import LANDMARKS, KernelMachine, fit_kernel_machine
from casecurve.operators.logistic_folds import fit_logistic_folds, score_logistic_folds
from casecurve.operators.metrics import best_threshold, overall_scores, score_areas
from casecurve.operators.quantiles import medians
from casecurve.operators.splits import assign_folds, stratified_split
from casecurve.session import saved_table

# Forest sizes and depths of the service, of the notebook study and of the climate study,
# iterations of the logistic model, default threshold and the stopping tolerance of the SVM.
FOREST_TREES, FOREST_DEPTH, SEED = 200, 6, 42
STUDY_FOREST_TREES, STUDY_FOREST_DEPTH = 300, 30
CLIMATE_FOREST_TREES = 13
LOGISTIC_ITERATIONS = 2000
DEFAULT_THRESHOLD = 0.5
FOURIER_FEATURES = 64
SVM_TOLERANCE = 1e-3
# Independent fits sent to the cluster at the same time: small ones, those whose rows fill all cores, and linear SVMs, whose
# hundreds of passes are too short for that.
PARALLEL_FITS, PARALLEL_LARGE_FITS, PARALLEL_LARGE_SVMS = 8, 2, 4
# Training rows that are worth a task of their own, and those of a task at most: a forest of 300 trees keeps some
# 1.3 KB in memory for each.
TASK_ROWS_LEAST, TASK_ROWS_MOST = 1 << 14, 1 << 18
# Forests nearly without a bound on their depth, with their trees; those of more rows than this are grown node by node.
DEEP_FORESTS, GROWN_ROWS_LEAST = {"forest_study": STUDY_FOREST_TREES, "forest_climate": CLIMATE_FOREST_TREES}, 2 * TASK_ROWS_LEAST


@dataclass
class Classifier:
    """A fitted pipeline with what is needed to turn its scores into decisions."""

    model: PipelineModel | FixedLogistic | KernelMachine | GrownForest
    classes: list[str]
    numeric: list[str]
    categorical: list[str]
    kind: str
    positive: str | None = None
    threshold: float = DEFAULT_THRESHOLD
    metrics: dict[str, float] = field(default_factory=dict)

    @property
    def has_probability(self) -> bool:
        return not self.kind.startswith("svm")


@dataclass
class FixedLogistic:
    """A two-class logistic model with given coefficients, for the first class; scores like a fitted pipeline."""

    weights: dict[str, float]
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        z = F.lit(self.intercept)
        for column, weight in self.weights.items():
            z = z + F.lit(weight) * F.col(column)
        p = 1.0 / (1.0 + F.exp(-z))
        return df.withColumn("probability", array_to_vector(F.array(p, 1.0 - p))).withColumn("_prediction", F.when(p >= 0.5, 0.0).otherwise(1.0))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _value_counts(rows: DataFrame, columns: Sequence[str], most: int) -> dict[str, dict]:
    """Each column's present values with their counts, in value order; one job for all columns.

    Every value becomes a feature or a class of the model, so more than ``most`` are an error.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counted = rows.select(F.explode(cells).alias("_c")).where("_c.value IS NOT NULL").groupBy("_c.column", "_c.value")
    found: dict[str, dict] = {c: {} for c in columns}
    for r in counted.agg(F.count(F.lit(1)).alias("n")).orderBy("column", "value").limit(len(columns) * most + 1).collect():
        found[r["column"]][r["value"]] = r["n"]
    for c, values in found.items():
        if len(values) > most:
            raise ValueError(f"{c} has more than {most} values")
    return found


def _preprocessing(
    rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], values: dict[str, dict]
) -> tuple[SQLTransformer, list[str]]:
    """The projection and the names of the feature columns it adds."""
    middle = {r["column"]: r["median"] for r in medians(rows, numeric).collect()}
    filled = {c: F.coalesce(lenient_double(F.col(c)), F.lit(float(middle.get(c) or 0.0))) for c in numeric}
    stats = rows.agg(*[a for c in numeric for a in (F.avg(filled[c]).alias(f"{c}_m"), F.stddev_pop(filled[c]).alias(f"{c}_s"))]).first()
    expressions = []
    for c in numeric:
        raw = f"TRY_CAST(`{c}` AS DOUBLE)"
        value = f"COALESCE(IF(ISNAN({raw}), NULL, {raw}), {_number(middle.get(c) or 0.0)})"
        expressions.append(f"({value} - {_number(stats[f'{c}_m'] or 0.0)}) / {_number(stats[f'{c}_s'] or 1.0)}")
    for c in categorical:
        counts = values[c]
        # Ties go to the first value in order.
        usual = _text(max(counts, key=counts.get)) if counts else "NULL"
        for v in kept_categories(list(counts)):
            expressions.append(f"IF(COALESCE(`{c}`, {usual}) = {_text(v)}, 1.0D, 0.0D)")
    names = [f"_f{i}" for i in range(len(expressions))]
    selected = ", ".join(f"{e} AS {n}" for e, n in zip(expressions, names))
    return SQLTransformer(statement=f"SELECT *, {selected} FROM __THIS__"), names


def preprocessed(
    df: DataFrame, keys: Sequence[str], numeric: Sequence[str], categorical: Sequence[str], max_categories: int = MAX_CATEGORIES
) -> DataFrame:
    """``keys`` and what the models see of each row: ``{column}_scaled`` numbers and ``{column}_{value}`` flags."""
    rows = saved_table(df.select(*keys, *numeric, *categorical), "training")
    values = _value_counts(rows, categorical, max_categories) if categorical else {}
    projection, features = _preprocessing(rows, numeric, categorical, values)
    names = [f"{c}_scaled" for c in numeric] + [f"{c}_{v}" for c in categorical for v in kept_categories(list(values[c]))]
    return projection.transform(rows).select(*keys, *[F.col(f).alias(n) for f, n in zip(features, names)])


def _fourier(rows: DataFrame, names: Sequence[str], seed: int, waves: int) -> tuple[list[SQLTransformer], list[str]]:
    """Random Fourier features approximating an RBF kernel with gamma = 1 / (features * variance).

    All waves come from one array expression: separate formulas would outgrow generated code. Its lambda is not
    generated code but walked, so a wave's product is written out: array functions would walk it number by number.
    """
    # The variance of all features together, from their own means and variances.
    parts = rows.agg(*[f(n) for n in names for f in (F.avg, F.var_pop)]).first()
    centres, spreads = np.array(parts[::2], dtype=float), np.array(parts[1::2], dtype=float)
    variance = float(spreads.mean() + centres.var()) or 1.0
    gamma = 1.0 / (len(names) * variance)
    rng = np.random.RandomState(seed)
    weights = rng.normal(scale=np.sqrt(2 * gamma), size=(waves, len(names)))
    shifts = rng.uniform(0, 2 * np.pi, size=waves)
    scale = float(np.sqrt(2.0 / waves))
    lines = [
        f"named_struct('b', {_number(b)}, {', '.join(f"'w{i}', {_number(w)}" for i, w in enumerate(row))})" for row, b in zip(weights, shifts)
    ]
    product = " + ".join(["l.b", *[f"l.w{i} * {n}" for i, n in enumerate(names)]])
    projected = SQLTransformer(
        statement=f"SELECT *, transform(array({', '.join(lines)}), l -> {_number(scale)} * cos({product})) AS _waves FROM __THIS__"
    )
    columns = [f"_r{i}" for i in range(waves)]
    spread = SQLTransformer(statement=f"SELECT *, {', '.join(f'_waves[{i}] AS {c}' for i, c in enumerate(columns))} FROM __THIS__")
    return [projected, spread], columns


def _estimator(kind: str, n_rows: int, seed: int):
    common = {"featuresCol": "_features", "labelCol": "_y", "predictionCol": "_prediction"}
    weighted = {**common, "weightCol": "weight"}
    if kind == "forest":
        return RandomForestClassifier(numTrees=FOREST_TREES, maxDepth=FOREST_DEPTH, seed=seed, **weighted)
    if kind == "forest_study":
        return RandomForestClassifier(numTrees=STUDY_FOREST_TREES, maxDepth=STUDY_FOREST_DEPTH, seed=seed, **weighted)
    if kind == "forest_climate":
        return RandomForestClassifier(numTrees=CLIMATE_FOREST_TREES, maxDepth=STUDY_FOREST_DEPTH, seed=seed, **common)
    if kind == "tree":
        return DecisionTreeClassifier(maxDepth=STUDY_FOREST_DEPTH, seed=seed, **common)
    if kind == "logistic":
        # A penalty of 1 on the summed loss is 1 / rows on the averaged one.
        return LogisticRegression(maxIter=LOGISTIC_ITERATIONS, regParam=1.0 / max(1, n_rows), standardization=False, **weighted)
    if kind == "bayes":
        return NaiveBayes(modelType="gaussian", **common)
    if kind in ("svm", "svm_multiclass"):
        svm = LinearSVC(regParam=1.0 / max(1, n_rows), standardization=False, tol=SVM_TOLERANCE, **weighted)
        return svm if kind == "svm" else OneVsRest(classifier=svm, parallelism=4, **weighted)
    raise ValueError(f"unknown classifier {kind}")


def fit_tasks(n_rows: int, cores: int) -> int:
    """Tasks that a fit of so many rows is dealt to; one: the rows stay where they lie."""
    needed = -(-n_rows // TASK_ROWS_MOST)
    if needed > cores:
        return -(-needed // cores) * cores
    return max(1, min(cores, -(-n_rows // TASK_ROWS_LEAST)))


def _dealt(rows: DataFrame, n_rows: int) -> DataFrame:
    """Training rows in even shares: a fit reads them again and again, and a small file is one share however many rows it has."""
    tasks = fit_tasks(n_rows, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks) if tasks > 1 else rows


def _fits_at_once(rows: DataFrame, kind: str | None = None) -> int:
    large = PARALLEL_LARGE_SVMS if kind == "svm" else PARALLEL_LARGE_FITS
    return large if rows.count() > 2 * TASK_ROWS_LEAST else PARALLEL_FITS


def train_classifier(
    train: DataFrame,
    label: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    kind: str = "forest",
    positive: str | None = None,
    seed: int = SEED,
    fourier_features: int = FOURIER_FEATURES,
    max_categories: int = MAX_CATEGORIES,
    min_instances: int = 1,
    landmarks: int = LANDMARKS,
    saved: bool = False,
) -> Classifier:
    """Fits one classifier with class-balanced weights.

    ``fourier_features`` sets how closely the RBF kernel of the SVM is met. ``max_categories`` bounds the
    values of a category or label, each of which becomes a feature or class; more raise an error.
    ``min_instances`` is the least number of rows on each side of a split of a tree; Spark has no control
    over the rows needed to try a split at all, of which this is the nearest relation. ``svm_rbf`` is the kernel
    machine itself, spanned by ``landmarks`` training rows; it is not stored by ``save_classifier``. The rows are read
    several times and written once for it, unless they are ``saved`` (or parts of a saved table) already. Deep forests of
    many rows are grown by ``grow_forest``, as Spark ML sends sums of every node from every task.
    """
    rows = train.select(*numeric, *categorical, label).where(F.col(label).isNotNull())
    rows = rows if saved else saved_table(rows, "training")
    values = _value_counts(rows, [label, *categorical], max_categories)
    counts = values[label]
    classes, n = list(counts), sum(counts.values())
    # Balanced: every class gets the same total weight.
    by_class = {c: (float(i), n / (len(classes) * counts[c])) for i, c in enumerate(classes)}
    number, weight = (F.create_map(*[F.lit(v) for c in classes for v in (c, by_class[c][j])]) for j in (0, 1))
    rows = rows.withColumns({"_y": number[F.col(label).cast("string")], "weight": weight[F.col(label).cast("string")]})
    projection, names = _preprocessing(rows, numeric, categorical, values)
    if kind == "svm_rbf":
        machine = fit_kernel_machine(rows, [projection], names, counts, landmarks=landmarks)
        return Classifier(machine, classes, list(numeric), list(categorical), kind, positive)
    if kind in DEEP_FORESTS and n > GROWN_ROWS_LEAST:
        weights = [by_class[c][1] if kind == "forest_study" else 1.0 for c in classes]
        forest = grow_forest(rows, projection, names, weights, DEEP_FORESTS[kind], STUDY_FOREST_DEPTH, seed, min_instances)
        return Classifier(forest, classes, list(numeric), list(categorical), kind, positive)
    stages: list = [projection]
    if kind.startswith("svm"):
        waves, names = _fourier(projection.transform(rows), names, seed, fourier_features)
        stages += waves
    estimator = _estimator(kind, n, seed)
    if estimator.hasParam("minInstancesPerNode"):
        estimator = estimator.setMinInstancesPerNode(min_instances)
    stages.append(VectorAssembler(inputCols=names, outputCol="_features"))
    fitted = _fitted_once(stages, estimator, _dealt(rows, n)) if kind.startswith("svm") else Pipeline(stages=[*stages, estimator]).fit(_dealt(rows, n))
    return Classifier(fitted, classes, list(numeric), list(categorical), kind, positive)


def _fitted_once(stages: list, estimator, rows: DataFrame) -> PipelineModel:
    """``estimator`` behind ``stages`` that need no fit and cost more than its passes: they run once, and what they give is kept for the fit."""
    seen = PipelineModel(stages).transform(rows).select("_features", "_y", "weight").persist()
    try:
        return PipelineModel([*stages, *Pipeline(stages=[estimator]).fit(seen).stages])
    finally:
        seen.unpersist()


def _class_index(classifier: Classifier, name: str) -> int:
    return classifier.classes.index(name)


def scored(df: DataFrame, classifier: Classifier) -> DataFrame:
    """Adds ``probabilities`` (class → value), ``score`` of the positive class and ``prediction``.

    ``score`` points at the *named* class whatever the class order. Two classes are decided by the
    threshold; a model without probabilities keeps its own label and reports 0.5 for each class.
    """
    out = classifier.model.transform(df)
    labels = F.array(*[F.lit(c) for c in classifier.classes])
    chosen = F.element_at(labels, F.col("_prediction").cast("int") + 1)
    if classifier.has_probability:
        shares = vector_to_array("probability")
    else:
        shares = F.array_repeat(F.lit(DEFAULT_THRESHOLD), len(classifier.classes))
    out = out.withColumn("_shares", shares)
    positive = classifier.positive or classifier.classes[-1]
    i = _class_index(classifier, positive)
    if classifier.has_probability:
        score: Column = F.element_at("_shares", i + 1)
    elif "rawPrediction" in out.columns and classifier.kind in ("svm", "svm_rbf"):
        score = F.element_at(vector_to_array("rawPrediction"), i + 1)
    else:
        score = (chosen == positive).cast("double")
    if classifier.has_probability and len(classifier.classes) == 2 and classifier.positive:
        other = classifier.classes[1 - i]
        chosen = F.when(score >= classifier.threshold, positive).otherwise(other)
    probabilities = F.map_from_arrays(labels, F.transform("_shares", lambda p: F.bround(p, 4)))
    return out.withColumns({"score": score, "probabilities": probabilities, "prediction": chosen}).select(
        *df.columns, "score", "probabilities", "prediction"
    )


def with_probability_columns(predicted: DataFrame, classifier: Classifier) -> DataFrame:
    """Batch form: ``predicted_disease`` and one ``prob_{class}`` column per class."""
    columns = {f"prob_{c}": F.col("probabilities")[c] for c in classifier.classes}
    return predicted.withColumns(columns).withColumnRenamed("prediction", "predicted_disease").drop("score", "probabilities")


def out_of_fold(
    df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str],
    kind: str, k: int = 5, positive: str | None = None, seed: int = SEED, stratified: bool = True,
) -> DataFrame:
    """``key, label, fold, score, prediction`` where no row is scored by a model that saw it.

    The folds come from one assignment. Two-class logistic models of all folds are fitted together, one job
    per Newton step; the k fits of other kinds are separate jobs sent from a few driver threads.
    """
    kept = df.select(key, label, *numeric, *categorical)
    folded = saved_table(assign_folds(kept, key, label if stratified else None, k, seed), "folds")
    if kind == "logistic" and folded.where(F.col(label).isNotNull()).select(label).distinct().limit(3).count() == 2:
        together = fit_logistic_folds(folded, label, numeric, categorical, saved=True)
        scored_ = score_logistic_folds(folded, together, positive).where(F.col(label).isNotNull())
        return saved_table(scored_.select(key, label, "fold", "score", "prediction"), "held-out")

    def one(i: int) -> DataFrame:
        fitted = train_classifier(folded.where(F.col("fold") != i), label, numeric, categorical, kind, positive, seed, saved=True)
        held_out = scored(folded.where(F.col("fold") == i), fitted)
        return held_out.select(key, label, "fold", "score", "prediction")

    with ThreadPoolExecutor(_fits_at_once(folded, kind)) as pool:
        parts = list(pool.map(one, range(k)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return saved_table(out, "held-out")


def fold_accuracy(held_out: DataFrame, label: str) -> DataFrame:
    """Accuracy in percent: each fold's, averaged over folds."""
    per_fold = held_out.groupBy("fold").agg(F.avg((F.col(label) == F.col("prediction")).cast("double")).alias("_a"))
    return per_fold.agg(F.count(F.lit(1)).alias("n_folds"), F.bround(F.avg("_a") * 100.0, 2).alias("accuracy"))


def train_with_threshold(
    df: DataFrame, key: str, label: str, positive: str, numeric: Sequence[str], categorical: Sequence[str],
    kind: str = "forest", test_percent: int = 20, folds: int = 5, seed: int = SEED,
) -> Classifier:
    """The full training run: split, threshold from out-of-fold scores, final fit, test metrics."""
    kept = df.select(key, label, *numeric, *categorical)
    split = saved_table(stratified_split(kept, key, label, test_percent, seed), "split")
    train, test = split.where("part = 'train'").drop("part"), split.where("part = 'test'").drop("part")
    held_out = out_of_fold(train, key, label, numeric, categorical, kind, folds, positive, seed)
    best = best_threshold(held_out, "score", F.col(label) == positive).first()
    fitted = train_classifier(train, label, numeric, categorical, kind, positive, seed, saved=True)
    if best and best["threshold"] is not None:
        fitted.threshold = float(best["threshold"])
    judged = saved_table(scored(test, fitted).select(label, "score", "prediction"), "judged")
    overall = overall_scores(judged, label, "prediction", positive).first().asDict()
    areas = score_areas(judged, "score", F.col(label) == positive).first()
    fitted.metrics = {**overall, "roc_auc": areas["roc_auc"], "average_precision": areas["average_precision"]}
    return fitted


def compare_models(
    df: DataFrame, key: str, label: str, positive: str, numeric: Sequence[str], categorical: Sequence[str],
    kinds: Sequence[str] = ("logistic", "forest", "svm"), test_percent: int = 20, seed: int = SEED,
) -> DataFrame:
    """Six measures per model on one common test part."""
    kept = df.select(key, label, *numeric, *categorical)
    split = saved_table(stratified_split(kept, key, label, test_percent, seed), "split")
    train, test = split.where("part = 'train'"), split.where("part = 'test'")

    def one(kind: str) -> DataFrame:
        fitted = train_classifier(train, label, numeric, categorical, kind, None, seed, saved=True)
        return scored(test, fitted).select(F.lit(kind).alias("model"), label, "prediction")

    with ThreadPoolExecutor(_fits_at_once(train)) as pool:
        parts = list(pool.map(one, kinds))
    judged = parts[0]
    for part in parts[1:]:
        judged = judged.unionByName(part)
    return overall_scores(judged, label, "prediction", positive, groups=["model"])
