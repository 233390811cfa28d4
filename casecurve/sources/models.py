"""Saving fitted models and parameter tables, and loading them with a fallback."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.operators.classify import Classifier
from casecurve.operators.forest import GrownForest


class NoModel(Exception):
    """A place that holds no whole model."""


def _missing(err: Exception) -> bool:
    """Nothing there, or not a model. Anything else, such as a storage error, says nothing of what is there."""
    if isinstance(err, AnalysisException):
        return err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
    return isinstance(err, (NoModel, json.JSONDecodeError))


def save_classifier(spark: SparkSession, classifier: Classifier, *paths: str) -> None:
    """Pipeline plus a one-row description, under every path."""
    about = {
        "classes": classifier.classes, "numeric": classifier.numeric, "categorical": classifier.categorical,
        "kind": classifier.kind, "positive": classifier.positive, "threshold": classifier.threshold,
        "metrics": classifier.metrics,
    }
    for path in paths:
        if isinstance(classifier.model, GrownForest):
            about["forest"] = classifier.model.stored(spark, f"{path}/forest")
        else:
            classifier.model.write().overwrite().save(f"{path}/pipeline")
        row = spark.range(1).select(F.lit(json.dumps(about)).alias("about"))
        row.write.mode("overwrite").parquet(f"{path}/about")


def load_classifier(spark: SparkSession, path: str) -> Classifier:
    row = spark.read.schema("about string").parquet(f"{path}/about").first()
    if row is None:
        raise NoModel(f"{path}/about is empty")
    about = json.loads(row["about"])
    forest = about.pop("forest", None)
    model = GrownForest.loaded(forest, f"{path}/forest") if forest else PipelineModel.load(f"{path}/pipeline")
    return Classifier(model=model, **about)


def load_or_train(spark: SparkSession, paths: Sequence[str], train: Callable[[], Classifier]) -> Classifier:
    """The first loadable model; if none is, a fresh one, saved under the first path."""
    for path in paths:
        try:
            return load_classifier(spark, path)
        except (AnalysisException, NoModel, json.JSONDecodeError) as err:
            if not _missing(err):
                raise
            print(f"no model at {path}: {type(err).__name__}")
    fitted = train()
    save_classifier(spark, fitted, paths[0])
    return fitted


def save_params(params: DataFrame, *paths: str) -> None:
    """A forecast parameter table (one row per series)."""
    for path in paths:
        params.write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, paths: Sequence[str], fit: Callable[[], DataFrame]) -> DataFrame:
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as err:
            if not _missing(err):
                raise
            print(f"no parameters at {path}: {type(err).__name__}")
    save_params(fit(), paths[0])
    return spark.read.parquet(paths[0])
