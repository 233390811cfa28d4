from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from casecurve.operators import classify, forest
from casecurve.sources import models


def planned(width, classes, depth=30, least=1, trees=1):
    return forest.Plan(trees, depth, least, 5, width, np.ones(classes))


@pytest.mark.parametrize("mean", [1, 3, 40, 2500])
def test_draws_are_poisson(mean):
    keys = np.arange(200_000).astype(np.uint64)
    low, points = forest.poisson_cut_points(mean)
    n = forest.drawn(keys, [(low, np.arange(len(keys)), points)], 1, 2)
    assert points[-1] == pytest.approx(1.0, abs=1e-9)
    assert n.mean() == pytest.approx(mean, rel=0.02) and n.var() == pytest.approx(mean, rel=0.03)
    if mean == 1:
        assert (n == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    other = forest.drawn(keys, [(low, np.arange(len(keys)), points)], 1, 3)
    assert abs(np.corrcoef(n, other)[0, 1]) < 0.01


@pytest.mark.parametrize("depth,least", [(30, 1), (4, 1), (30, 7)])
def test_a_tree_of_all_features_is_spark_mls(spark, depth, least):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, (1500, 2))
    y = np.where(rng.random(1500) < 0.15, rng.integers(0, 3, 1500), (x[:, 0] * 3 + x[:, 1]) % 40 // 14)
    nodes, values = forest.grow(x.astype(np.uint8), y.astype(np.int32), np.ones(1500), 0, 1, 0, planned(2, 3, depth, least))
    got = values[nodes.reached(x.astype(np.uint8))]
    df = spark.createDataFrame([(i, Vectors.dense([float(v) for v in a]), float(b)) for i, (a, b) in enumerate(zip(x, y))], ["i", "f", "y"])
    tree = DecisionTreeClassifier(featuresCol="f", labelCol="y", maxDepth=depth, minInstancesPerNode=least).fit(df.coalesce(1))
    expected = np.array([r.probability.toArray() for r in tree.transform(df).orderBy("i").select("probability").collect()])
    # Of several equally good cuts either may be taken.
    assert (np.abs(got - expected).max(1) < 1e-6).mean() > 0.97
    assert (got[np.arange(1500), y].mean()) == pytest.approx(expected[np.arange(1500), y].mean(), abs=0.01)


@pytest.fixture(scope="module")
def noisy(spark):
    h = lambda salt: F.abs(F.xxhash64("id", F.lit(salt)))
    rows = spark.range(6000, numPartitions=3).select(
        "id", *[(h(i) % m).cast("double").alias(c) for i, (c, m) in enumerate([("a", 1000), ("b", 50), ("c", 7), ("d", 2)])], (h(9) % 100).alias("u")
    )
    high = (F.col("a") + 12 * F.col("b") + 50 * F.col("d")) / 300
    label = F.when(F.col("u") < 15, F.col("u") % 3).otherwise(F.least(F.lit(2), F.floor(high)))
    return rows.select("id", "a", "b", "c", "d", label.cast("int").cast("double").alias("_y")).cache()


NAMES = ["_fa", "_fb", "_fc", "_fd"]


def projection():
    return SQLTransformer(statement="SELECT *, a AS _fa, b AS _fb, c AS _fc, d AS _fd FROM __THIS__")


def shares(forest_, rows):
    out = forest_.transform(rows).orderBy("id").select("probability", "_prediction").collect()
    return np.array([r.probability.toArray() for r in out]), np.array([r["_prediction"] for r in out])


@pytest.mark.parametrize("depth", [30, 5])
def test_nodes_split_by_all_tasks_are_those_of_one_task(spark, noisy, monkeypatch, depth):
    whole = forest.grow_forest(noisy, projection(), NAMES, [1.0, 2.0, 0.5], 6, depth, 11)
    assert all(len(t.child) == 1 for t in whole.tops)
    monkeypatch.setattr(forest, "NODE_ROWS", 300)
    monkeypatch.setattr(forest, "SHARE_ROWS", 100)
    parted = forest.grow_forest(noisy.repartition(5), projection(), NAMES, [1.0, 2.0, 0.5], 6, depth, 11)
    assert all(len(t.child) > 10 for t in parted.tops)
    a, b = shares(whole, noisy), shares(parted, noisy)
    assert np.abs(a[0] - b[0]).max() < 1e-5 and (a[1] == b[1]).mean() > 0.999
    assert a[0].sum(1) == pytest.approx(1.0, abs=1e-5)


def test_copies_count_as_rows(spark, noisy):
    """A forest on rows five times over is not one on each row once: samples hold nearly all rows."""
    five = noisy.crossJoin(spark.range(5).select(F.col("id").alias("copy"))).drop("copy")
    once, often = (forest.grow_forest(r, projection(), NAMES, [1.0] * 3, 10, 30, 3) for r in (noisy, five))
    rows = noisy.orderBy("id").collect()
    y = np.array([int(r["_y"]) for r in rows])
    a, b = shares(once, noisy)[0], shares(often, noisy)[0]
    assert b[np.arange(len(y)), y].mean() > a[np.arange(len(y)), y].mean() + 0.015


@pytest.mark.parametrize("kind", ["forest_study", "forest_climate"])
def test_deep_forest_of_many_rows(spark, noisy, monkeypatch, tmp_path, kind):
    """Not by Spark ML, whose tasks send sums of every node; as good on rows not seen; stored and loaded."""
    monkeypatch.setattr(classify, "STUDY_FOREST_TREES", 40)
    monkeypatch.setitem(classify.DEEP_FORESTS, "forest_study", 40)
    rows = noisy.withColumn("label", F.concat(F.lit("c"), F.col("_y").cast("int").cast("string"))).withColumn("gender", F.when(F.col("d") == 1, "m").otherwise("f"))
    rows = rows.withColumn("b", F.when(F.col("id") % 19 > 0, F.col("b"))).drop("_y")
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")

    def right(fitted):
        return classify.scored(test, fitted).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]

    by_spark = right(classify.train_classifier(train, "label", ["a", "b", "c"], ["gender"], kind))
    monkeypatch.setattr(classify, "GROWN_ROWS_LEAST", 1000)
    fitted = classify.train_classifier(train, "label", ["a", "b", "c"], ["gender"], kind)
    assert isinstance(fitted.model, forest.GrownForest) and len(fitted.model.tops) == classify.DEEP_FORESTS[kind]
    assert right(fitted) > 0.75 and right(fitted) == pytest.approx(by_spark, abs=0.03)
    path = str(tmp_path / "model")
    models.save_classifier(spark, fitted, path)
    a, b = (classify.scored(test, m).select("id", "score", "prediction", "probabilities").orderBy("id").collect() for m in (fitted, models.load_classifier(spark, path)))
    assert a == b and len(a) == 1500
