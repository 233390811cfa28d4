"""Quantiles, splits, running totals, curves, neighbours and naive Bayes against brute force."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casecurve.operators import bayes, features, impute, joins, knn, metrics, profile, running, splits
from casecurve.operators.quantiles import summarise_values


def test_quantiles_through_brackets_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    values = np.where(rng.random(60_000) < 0.34, 7.25, rng.lognormal(2, 1, 60_000))
    frame = pd.DataFrame({"g": np.where(rng.random(60_000) < 0.8, "big", "small"), "x": values})
    df = spark.createDataFrame(frame)
    # accuracy 200 puts both groups far above the size at which the whole range is the bracket
    out = summarise_values(df, ["x"], (0.1, 0.25, 0.5, 0.9), ["g"], accuracy=200).collect()
    for r in out:
        mine = frame.x[frame.g == r.g].to_numpy()
        assert len(mine) > 2000
        assert list(r.quantiles) == pytest.approx(np.quantile(mine, [0.1, 0.25, 0.5, 0.9]), rel=1e-12)


def test_quantiles_skip_missing_numbers(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("a", 2.0), (None, 9.0)], "g string, x double")
    row = summarise_values(df, ["x"], (0.5,), ["g"]).first()
    assert (row["count"], row.quantiles) == (2, [1.5])


def test_impute(spark):
    df = spark.createDataFrame([(1.0, "m"), (None, "f"), (4.0, "f"), (float("nan"), None)], "x double, g string")
    assert sorted(r.x for r in impute.fill_median(df, ["x"]).collect()) == [1.0, 2.5, 2.5, 4.0]
    assert impute.fill_mode(df, "g").where("g = 'f'").count() == 3
    train = spark.createDataFrame([(10.0,), (20.0,)], "x double")
    assert impute.fill_mean(df, ["x"], statistics_from=train).where("x = 15").count() == 2


def test_stratified_split_is_exact_and_repeatable(spark):
    df = spark.range(3001).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("label"))
    out = splits.stratified_split(df, "id", "label")
    counts = out.groupBy("label").agg(F.count("id").alias("n"), F.count_if(F.col("part") == "test").alias("t")).collect()
    assert all(r.t == (r.n * 20 + 99) // 100 for r in counts)
    again = splits.stratified_split(df.repartition(5), "id", "label")
    assert out.exceptAll(again).count() == 0


def test_copies_of_a_key_stay_together(spark):
    df = spark.range(300).select((F.col("id") % 10).alias("id"), F.lit("a").alias("label"))
    out = splits.stratified_split(df, "id", "label")
    assert out.groupBy("id").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0


def test_folds_differ_by_at_most_one(spark):
    out = splits.assign_folds(spark.range(1003), "id", k=10, seed=0)
    sizes = [r["count"] for r in out.groupBy("fold").count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 1003 and max(sizes) - min(sizes) <= 1
    tiny = splits.assign_folds(spark.range(3), "id", k=5)
    assert tiny.count() == 3 and tiny.select("fold").distinct().count() == 3


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"s": rng.permutation(5000).astype(float) ** 3, "n": rng.integers(0, 9, 5000)})
    out = running.running_totals(spark.createDataFrame(frame), "s", ["n"], descending, slices=16).toPandas()
    expected = frame.sort_values("s", ascending=not descending).n.cumsum()
    got = out.sort_values("s", ascending=not descending).n_upto
    assert got.tolist() == expected.tolist()


def test_running_totals_over_ten_thousand_slices(spark):
    frame = pd.DataFrame({"s": np.random.default_rng(4).permutation(10_000) / 7.0, "n": np.arange(10_000) % 13})
    df = spark.createDataFrame(frame)
    for descending in (True, False):
        out = running.running_totals(df, "s", ["n"], descending, slice_rows=1).toPandas().sort_values("s", ascending=not descending)
        assert (out["n_upto"] == out["n"].cumsum()).all()


@pytest.mark.parametrize("descending", [True, False])
def test_offsets_by_level(spark, descending):
    """Three levels: no window holds more than a block, and every slice gets what lies before it."""
    totals = spark.range(700).selectExpr("cast(id as int) as _slice", "id % 5 as a", "1 as b").where("_slice % 11 <> 3")
    got = {r["_slice"]: (r["_a"], r["_b"]) for r in running.offsets(totals, 700, ["a", "b"], descending, block=8).collect()}
    a = b = 0
    for i in sorted((i for i in range(700) if i % 11 != 3), reverse=descending):
        assert got.pop(i) == (a, b)
        a, b = a + i % 5, b + 1
    assert not got


def test_slices_stay_within_their_size(spark):
    df = spark.range(40_000).selectExpr("cast(exp(id / 2000.0) as double) as s")
    n, rows = 40, 1000
    points = df.approxQuantile("s", [i / n for i in range(1, n)], 1 / (4 * n))
    sizes = np.histogram([r.s for r in df.collect()], [-np.inf, *sorted(set(points)), np.inf])[0]
    assert sizes.max() <= 1.5 * rows + 1


def test_numbered_rows_cover_the_range(spark):
    out = running.numbered(spark.range(0, 2000, 3), "id").toPandas().sort_values("id")
    assert out.position.tolist() == list(range(len(out)))


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label string")


def test_hand_checked_areas(spark):
    df = scored(spark, [(0.9, "p"), (0.8, "n"), (0.8, "p"), (0.1, "n")])
    out = metrics.score_areas(df, "score", F.col("label") == "p").first()
    assert (out.roc_auc, out.average_precision) == (0.875, 0.8333)


def test_areas_and_threshold_against_brute_force(spark):
    rng = np.random.default_rng(8)
    score = rng.integers(0, 60, 800) / 60
    label = rng.random(800) < score
    df = scored(spark, [(float(s), "p" if p else "n") for s, p in zip(score, label)])
    pos, neg = score[label], score[~label]
    auc = np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])
    assert metrics.score_areas(df, "score", F.col("label") == "p", 9).first().roc_auc == pytest.approx(auc, abs=1e-8)
    best = None
    for t in sorted(set(score)):
        tp, fp = (pos >= t).sum(), (neg >= t).sum()
        p, r = tp / (tp + fp), tp / len(pos)
        f1 = 2 * p * r / (p + r + 1e-10)
        if best is None or f1 > best[1]:
            best = (t, f1)
    out = metrics.best_threshold(df, "score", F.col("label") == "p").first()
    assert (out.threshold, out.f1) == pytest.approx(best)


def test_one_sided_labels_give_no_area(spark):
    out = metrics.score_areas(scored(spark, [(0.5, "p"), (0.6, "p")]), "score", F.col("label") == "p").first()
    assert out.roc_auc is None and out.average_precision == 1.0
    curve = metrics.precision_recall_curve(scored(spark, [(0.5, "n")]), "score", F.col("label") == "p").first()
    assert (curve.precision, curve.recall, curve.f1) == (0.0, 1.0, 0.0)


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("a", "a"), ("c", "b")], "label string, prediction string")
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert (report["c"].precision, report["c"].recall, report["c"].support) == (0.0, 0.0, 1)
    assert report["a"].precision == 0.6667 and report["accuracy"].f1 == 0.5
    overall = metrics.overall_scores(df, positive="a").first()
    assert (overall.accuracy, overall.balanced_accuracy, overall.positive_recall) == (0.5, 0.3333, 1.0)
    matrix = metrics.confusion_matrix(df, ["a", "b", "zzz"]).orderBy("position").collect()
    assert [tuple(r)[2:] for r in matrix] == [(2, 0, 0), (1, 0, 0), (0, 0, 0)]


def test_class_weights_and_one_hot(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",)], "label string")
    rows = {r.label: r.weight for r in features.with_class_weight(df, "label").collect()}
    assert rows == {"a": pytest.approx(4 / 6), "b": 2.0}
    assert features.one_hot(df, "label").columns == ["label", "label_b"]
    unseen = features.one_hot(spark.createDataFrame([("z",)], "label string"), "label", ["a", "b", "c"]).first()
    assert tuple(unseen)[1:] == (0, 0, 0)
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert features.standardised(constant, ["x"]).first().x == 0.0


def vectors(spark, n, seed, copies=0, dims=4):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dims)).round(2)
    if copies:
        data[:copies] = data[0]
    rows = [(int(i), [float(v) for v in data[i]], int(rng.integers(0, 3))) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


@pytest.mark.parametrize("options", [{}, {"small_values": 0, "block_rows": 40}])
def test_neighbours_with_a_third_of_equal_rows(spark, options):
    train, held = vectors(spark, 600, 1, copies=200)
    queries, asking = vectors(spark, 90, 2, copies=30)
    got = knn.nearest_neighbours(queries, train, 5, **options).toPandas().sort_values(["query_id", "rank"])
    matrix = np.array([r[1] for r in held], dtype=np.float32).astype(float)
    expected = []
    for qid, q, _ in asking:
        d = np.sqrt(((matrix - np.array(q, dtype=np.float32).astype(float)) ** 2).sum(axis=1))
        expected.append([held[i][0] for i in np.lexsort((np.arange(len(d)), d))[:5]])
    assert got.groupby("query_id").neighbour_id.apply(list).tolist() == expected


def test_fewer_training_rows_than_neighbours(spark):
    train, _ = vectors(spark, 3, 1)
    queries, _ = vectors(spark, 4, 2)
    for options in ({}, {"small_values": 0}):
        assert knn.nearest_neighbours(queries, train, 5, **options).groupBy("query_id").count().where("count = 3").count() == 4


def test_naive_bayes_against_numpy(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 200)
    x = rng.normal(size=(200, 2)) + y[:, None] * 1.5
    df = spark.createDataFrame([(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "id long, a double, b double, label int")
    cols = [F.col("a"), F.col("b")]
    out = bayes.score_gaussian_nb(df, bayes.fit_gaussian_nb(df, cols), cols).toPandas().sort_values("id")
    eps = 1e-9 * x.var(axis=0).max()
    joint = np.stack([
        np.log((y == c).mean()) - 0.5 * (np.log(2 * np.pi * (x[y == c].var(axis=0) + eps)) + (x - x[y == c].mean(axis=0)) ** 2 / (x[y == c].var(axis=0) + eps)).sum(axis=1)
        for c in (0, 1)
    ])
    assert out.prediction.tolist() == joint.argmax(axis=0).tolist()
    assert out.log_joint.to_numpy() == pytest.approx(joint.max(axis=0))
    folded = df.withColumn("fold", (F.col("id") % 4).cast("int"))
    cv = bayes.cross_validated_nb(folded, cols, "label", k=4).toPandas().sort_values("id")
    for f in range(4):
        keep = np.arange(200) % 4 != f
        xt, yt = x[keep], y[keep]
        eps = 1e-9 * xt.var(axis=0).max()
        j = np.stack([
            np.log((yt == c).mean()) - 0.5 * (np.log(2 * np.pi * (xt[yt == c].var(axis=0) + eps)) + (x[~keep] - xt[yt == c].mean(axis=0)) ** 2 / (xt[yt == c].var(axis=0) + eps)).sum(axis=1)
            for c in (0, 1)
        ])
        assert cv.prediction[cv.fold == f].tolist() == j.argmax(axis=0).tolist()


def test_duplicates_and_profile(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 1), ("x", 1)], "t string, n int")
    assert profile.duplicate_count(df).first()[:] == (4, 1)
    assert profile.duplicate_count(df, ["t"], digest=True).first()[:] == (4, 2)
    assert {r.column: r.n_missing for r in profile.null_counts(df).collect()} == {"t": 0, "n": 2}
    counts = [(r.value, r.n) for r in profile.value_counts(df, "n").collect()]
    assert counts == [(None, 2), (1, 2)]


def test_natural_join_on_several_keys(spark):
    features_ = spark.createDataFrame([("sj", 1990, 18, 0.1), ("sj", 1990, 19, 0.2), ("iq", 1990, 18, 0.3)], "city string, year int, weekofyear int, ndvi double")
    labels = spark.createDataFrame([("sj", 1990, 18, 4), ("iq", 1990, 18, 0), ("iq", 1991, 1, 2)], "city string, year int, weekofyear int, total_cases int")
    out = joins.natural_join(features_, labels)
    assert sorted((r.city, r.ndvi, r.total_cases) for r in out.collect()) == [("iq", 0.3, 0), ("sj", 0.1, 4)]
    fit = profile.linear_fit(out.unionByName(out.withColumn("ndvi", F.col("ndvi") + 1).withColumn("total_cases", F.col("total_cases") + 2)), "ndvi", "total_cases", ["city"])
    assert {r.city: (r.slope, r.r2) for r in fit.collect()} == {"sj": (2.0, 1.0), "iq": (2.0, 1.0)}


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(2, "other"), (3, "z")], "id int, v string")
    assert sorted(tuple(r) for r in joins.prefer_first(a, b, ["id"]).collect()) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError):
        joins.natural_join(a.select("v"), b.select("id"))
    rows = joins.assign_round_robin(spark.range(7), spark.createDataFrame([(10,), (20,), (30,)], "c long"), "id", "c", "center_id")
    assert [r.center_id for r in rows.orderBy("id").collect()] == [10, 20, 30, 10, 20, 30, 10]


def test_round_robin_on_keys_beyond_doubles(spark):
    from casecurve.operators.joins import assign_round_robin

    keys = [(1 << 60) + i for i in range(500)]
    targets = spark.createDataFrame([(k,) for k in reversed(keys)], "target long")
    rows = spark.createDataFrame([(i,) for i in range(1000)], "position long")
    got = {r.position: r.given for r in assign_round_robin(rows, targets, "position", "target", "given").collect()}
    assert got == {i: keys[i % 500] for i in range(1000)}


def test_neighbours_vote_for_text_labels(spark):
    from casecurve.operators import knn

    rows = [(i, [float(i % 10), float(i // 10)], "near" if i < 50 else "far") for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for values in (4_000_000, 1):
        got = {r.query_id: r.prediction for r in knn.knn_classify(df, df, 5, small_values=values, block_rows=16).collect()}
        for i, vector, _ in rows:
            gaps = sorted((math.dist(vector, v), j, label) for j, v, label in rows)[:5]
            votes = [label for *_, label in gaps]
            assert got[i] == min(set(votes), key=lambda x: (-votes.count(x), x))


def test_bayes_with_many_classes_and_folds(spark):
    from casecurve.operators import bayes

    rng = np.random.RandomState(4)
    rows = [(i, i % 150, float(i % 150) + rng.normal() * 0.01, rng.normal(), i // 150 % 10) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label int, a double, b double, fold int")
    features = [F.col("a"), F.col("b")]
    got = {r.id: r.prediction for r in bayes.cross_validated_nb(df, features, "label").collect()}
    # The same, fold by fold, with the other folds' rows.
    for fold in (0, 7):
        params = bayes.fit_gaussian_nb(df.where(F.col("fold") != fold), features)
        for r in bayes.score_gaussian_nb(df.where(F.col("fold") == fold), params, features).collect():
            assert got[r.id] == r.prediction
    assert np.mean([got[i] == label for i, label, *_ in rows]) > 0.95


def test_training_reads_text_numbers_as_missing(spark):
    from casecurve.operators import classify

    rows = [("unknown" if i % 10 == 0 else str(i % 40), "m" if i % 2 else "f", "yes" if i % 40 > 20 else "no") for i in range(400)]
    df = spark.createDataFrame(rows, "age string, gender string, label string")
    fitted = classify.train_classifier(df, "label", ["age"], ["gender"], "logistic", "yes")
    judged = classify.scored(df, fitted).where("age <> 'unknown'")
    assert judged.where("label = prediction").count() > 0.9 * judged.count()


def test_prefix_grows_with_the_rows():
    from casecurve.operators.splits import prefix_for

    assert [prefix_for(n) for n in (0, 10**6, 10**9, 10**11)] == [3, 3, 4, 5]
