from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from casecurve.operators import classify


def test_tasks_of_a_fit():
    assert classify.fit_tasks(0, 12) == classify.fit_tasks(13_000, 12) == 1
    assert classify.fit_tasks(20_000, 12) == 2 and classify.fit_tasks(1_000_000, 12) == 12
    # Beyond a task's share for each core the tasks grow with the rows, in whole rounds.
    assert classify.fit_tasks(4_700_000, 12) == 24
    assert all(n / classify.fit_tasks(n, c) <= classify.TASK_ROWS_MOST for n in (10**6, 10**7, 10**9) for c in (1, 8, 12))


@pytest.mark.parametrize("kind", ["forest_climate", "svm", "tree"])
def test_one_file_of_rows_is_fitted_by_several_tasks(spark, monkeypatch, kind):
    rows = spark.range(20_000, numPartitions=1).select(
        (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"),
        F.when(F.col("id") % 97 < 30, "yes").otherwise("no").alias("label"),
    )
    fitted_on, fit = [], classify.Pipeline.fit

    def spied(self, data, *more):
        fitted_on.append([r["n"] for r in data.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()])
        return fit(self, data, *more)

    monkeypatch.setattr(classify.Pipeline, "fit", spied)
    fitted = classify.train_classifier(rows, "label", ["a", "b"], [], kind)
    assert fitted_on == [[10_000, 10_000]]
    right = classify.scored(rows, fitted).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert right > 0.95


def test_waves_against_numpy(spark):
    x = np.random.default_rng(1).normal(size=(50, 3))
    df = spark.createDataFrame([[float(v) for v in r] for r in x], "a double, b double, c double").coalesce(1)
    stages, columns = classify._fourier(df, ["a", "b", "c"], 7, 5)
    out = df
    for s in stages:
        out = s.transform(out)
    rng = np.random.RandomState(7)
    gamma = 1.0 / (3 * x.var())
    weights, shifts = rng.normal(scale=np.sqrt(2 * gamma), size=(5, 3)), rng.uniform(0, 2 * np.pi, size=5)
    got = np.array(out.select(*columns).collect())
    assert got == pytest.approx(np.sqrt(2 / 5) * np.cos(x @ weights.T + shifts), abs=1e-12)


@pytest.mark.parametrize("kind", ["svm", "svm_multiclass"])
def test_waves_are_kept_while_an_svm_is_fitted(spark, monkeypatch, kind):
    rows = spark.range(900, numPartitions=1).select(
        (F.col("id") % 97).cast("double").alias("a"), (F.col("id") % 89).cast("double").alias("b"),
        F.when(F.col("id") % 97 < 30, "yes").otherwise("no").alias("label"),
    )
    kept, seen, fit = [], [], classify.Pipeline.fit

    def spied(self, data, *more):
        kept.append(data.storageLevel.useMemory and data.storageLevel.useDisk and "_features" in data.columns)
        seen.append(data)
        return fit(self, data, *more)

    monkeypatch.setattr(classify.Pipeline, "fit", spied)
    fitted = classify.train_classifier(rows, "label", ["a", "b"], [], kind)
    assert kept == [True] and not seen[0].storageLevel.useMemory
    # The model is the one of the whole pipeline, its stages run again for every pass.
    n_yes = rows.where("label = 'yes'").count()
    yes = F.col("label") == "yes"
    labelled = rows.withColumns({"_y": F.when(yes, 1.0).otherwise(0.0), "weight": F.when(yes, 450 / n_yes).otherwise(450 / (900 - n_yes))})
    plain = fit(classify.Pipeline(stages=[*fitted.model.stages[:-1], classify._estimator(kind, 900, classify.SEED)]), labelled)
    machines = [m.stages[-1] if kind == "svm" else m.stages[-1].models[0] for m in (fitted.model, plain)]
    assert machines[0].coefficients.toArray() == pytest.approx(machines[1].coefficients.toArray(), rel=1e-6)
    right = classify.scored(rows, fitted).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert right > 0.95
