"""Logistic regression of all folds together against a plain fit per fold."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casecurve.operators import classify, logistic_folds
from casecurve.operators.splits import assign_folds

SCHEMA = "id int, label string, age string, dose double, city string, gender string, fold int"


def odd_rows(seed=1, n=400, k=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        age, dose = rng.gauss(40, 12), rng.gauss(0, 1)
        city, gender = rng.choice(["a", "b", "c", None]), rng.choice(["f", "m", "m", None])
        label = "yes" if (age - 40) / 12 + dose + (city == "a") + rng.gauss(0, 1.5) > 0.6 else "no"
        rows.append((i, label, rng.choice([f"{age:.1f}"] * 9 + ["n/a"]), dose if rng.random() < 0.9 else None, city, gender, i % k))
    rows += [(n, None, "1", 0.0, "a", "f", 0), (n + 1, "yes", "2", 0.0, "a", "f", None), (n + 2, "no", None, None, None, None, 1)]
    rows += [(n + 3 + i, "no", "30", 0.1, "only in fold 0", "f", 0) for i in range(5)] + [rows[7]] * 3
    return rows


def number(x):
    try:
        value = float(x)
    except (TypeError, ValueError):
        return None
    return None if np.isnan(value) else value


def fit_by_hand(train):
    """(terms -> coefficient, score function) of one training part; the preprocessing written out."""
    y = np.array([r[1] == "yes" for r in train], float)
    columns, info = [], []
    for j in (2, 3):
        present = [number(r[j]) for r in train if number(r[j]) is not None]
        median = float(np.median(present))
        x = np.array([median if number(r[j]) is None else number(r[j]) for r in train])
        info.append((median, x.mean(), x.std()))
        columns.append((x - x.mean()) / x.std())
    groups = []
    for j in (4, 5):
        values = sorted({r[j] for r in train if r[j] is not None})
        mode = max(values, key=lambda v: sum(r[j] == v for r in train))
        kept = values[1:] if len(values) == 2 else values
        groups.append((mode, kept))
        columns += [np.array([float((r[j] if r[j] is not None else mode) == v) for r in train]) for v in kept]
    x = np.column_stack([*columns, np.ones(len(train))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    ridge = np.ones(x.shape[1])
    ridge[-1] = 0
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve(x.T @ (x * (w * p * (1 - p))[:, None]) + np.diag(ridge), x.T @ (w * (p - y)) + ridge * beta)
    names = ["age", "dose", *[f"{c}={v}" for c, (_, kept) in zip(("city", "gender"), groups) for v in kept], "intercept"]

    def score(r):
        cells = [((m if number(r[j]) is None else number(r[j])) - mean) / std for j, (m, mean, std) in zip((2, 3), info)]
        cells += [float((r[j] if r[j] is not None else mode) == v) for j, (mode, kept) in zip((4, 5), groups) for v in kept]
        return 1 / (1 + np.exp(-np.dot([*cells, 1.0], beta)))

    return dict(zip(names, beta)), score


def test_every_fold_as_if_fitted_alone(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fitted = logistic_folds.fit_logistic_folds(df, "label", ["age", "dose"], ["city", "gender"])
    usable = [r for r in rows if r[1] is not None and r[6] is not None]
    by_hand = {m: fit_by_hand([r for r in usable if r[6] != m]) for m in (-1, 0, 1, 2, 3)}
    for m, (want, _) in by_hand.items():
        got = dict(zip(fitted.terms, fitted.coefficients[m]))
        assert {t: got[t] for t in want} == pytest.approx(want, abs=1e-7)
        assert all(abs(c) < 1e-7 for t, c in got.items() if t not in want)
    assert fitted.passes < 15
    scored = logistic_folds.score_logistic_folds(df.where("fold IS NOT NULL"), fitted, "yes").collect()
    for r in scored:
        plain = tuple(r)[:7]
        assert r.score == pytest.approx(by_hand[r.fold][1](plain), abs=1e-7)
        assert r.prediction == ("yes" if r.score >= 0.5 else "no")


def test_one_job_per_step_whatever_the_folds(spark):
    rows = odd_rows(k=20)
    df = spark.createDataFrame(rows, SCHEMA)
    few = logistic_folds.fit_logistic_folds(df.withColumn("fold", F.col("fold") % 3), "label", ["dose"])
    many = logistic_folds.fit_logistic_folds(df, "label", ["dose"])
    assert len(many.coefficients) == 21 and many.passes <= few.passes + 2


def test_same_as_spark_ml(spark):
    df = spark.createDataFrame([r for r in odd_rows() if r[1] and r[6] is not None], SCHEMA)
    fitted = logistic_folds.fit_logistic_folds(df, "label", ["age", "dose"], ["city", "gender"])
    for m in (0, 2):
        model = classify.train_classifier(df.where(F.col("fold") != m), "label", ["age", "dose"], ["city", "gender"], "logistic", "yes")
        ours = {r.id: r.score for r in logistic_folds.score_logistic_folds(df.where(F.col("fold") == m), fitted, "yes").collect()}
        theirs = {r.id: r.score for r in classify.scored(df.where(F.col("fold") == m), model).collect()}
        assert ours == pytest.approx(theirs, abs=2e-3)


def test_out_of_fold_takes_the_one_pass_way(spark):
    df = spark.createDataFrame([r[:6] for r in odd_rows()], SCHEMA.rsplit(",", 1)[0])
    got = classify.out_of_fold(df, "id", "label", ["age", "dose"], ["city", "gender"], "logistic", 5, "yes")
    folded = assign_folds(df, "id", "label", 5, classify.SEED)
    sizes = {r.fold: r["count"] for r in folded.where("label IS NOT NULL").groupBy("fold").count().collect()}
    assert {r.fold: r["count"] for r in got.groupBy("fold").count().collect()} == sizes
    accuracy = classify.fold_accuracy(got, "label").first()
    assert accuracy.n_folds == 5 and accuracy.accuracy > 65


def test_separable_rows_one_class_and_wrong_labels(spark):
    rows = [(i, "yes" if i > 50 else "no", str(i), None, None, None, 0 if i > 50 else 1) for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    fitted = logistic_folds.fit_logistic_folds(df, "label", ["age", "dose"], ["city"])
    scores = logistic_folds.score_logistic_folds(df, fitted).collect()
    # Each fold holds a whole class out, so its model knows only the other one.
    assert all(r.prediction != r.label for r in scores)
    whole = dict(zip(fitted.terms, fitted.coefficients[-1]))
    assert whole["age"] > 1 and whole["dose"] == 0
    with pytest.raises(ValueError, match="two classes"):
        logistic_folds.fit_logistic_folds(df.withColumn("label", F.col("age")), "label", ["dose"])
    with pytest.raises(ValueError, match="more than 2 values"):
        logistic_folds.fit_logistic_folds(df, "label", ["dose"], ["age"], max_categories=2)
