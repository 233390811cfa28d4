"""The kernel machine: exact with all rows as landmarks, close with fewer."""

from __future__ import annotations

import numpy as np
import pytest

from casecurve.operators import classify, kernel_svm


def moons(n, seed=0, noise=0.25):
    rng = np.random.default_rng(seed)
    turn = rng.uniform(0, np.pi, n)
    side = rng.random(n) < 0.35
    x = np.where(side, np.cos(turn), 1 - np.cos(turn)) + rng.normal(0, noise, n)
    y = np.where(side, np.sin(turn), 0.5 - np.sin(turn)) + rng.normal(0, noise, n)
    return [(i, float(a), float(b), "one" if s else "two") for i, (a, b, s) in enumerate(zip(x, y, side))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, a double, b double, label string").repartition(2)


def test_rounded_hinge():
    margin = np.linspace(-1, 3, 401)
    for width in (1.0, 0.01):
        value, slope, curve = kernel_svm.rounded_hinge(margin, width)
        assert np.abs(value - np.maximum(0, 1 - margin)).max() <= width / 4 + 1e-12
        h = 1e-6
        up, down = (kernel_svm.rounded_hinge(margin + s, width)[0] for s in (h, -h))
        assert slope == pytest.approx((up - down) / (2 * h), abs=1e-4)
        assert (curve >= 0).all()


def test_features_have_the_kernel_as_inner_products():
    x = np.random.default_rng(1).normal(size=(60, 3))
    x[10:20] = x[0]
    kernel = kernel_svm.Landmarks.of(x, 0.7)
    f = kernel.features(x)[:, :-1]
    assert f @ f.T == pytest.approx(kernel_svm.rbf(x, x, 0.7), abs=1e-7)
    few = kernel_svm.Landmarks.of(x[:20], 0.7)
    g = few.features(x)[:, :-1]
    assert (g[:20] @ g.T) == pytest.approx(kernel_svm.rbf(x[:20], x, 0.7), abs=1e-6)


def test_all_rows_as_landmarks_meet_the_conditions_of_the_exact_machine(spark):
    """The optimum of the kernel machine: multipliers within their costs, zero beyond the margin, full within it."""
    rows = moons(120)
    fitted = classify.train_classifier(frame(spark, rows), "label", ["a", "b"], [], "svm_rbf", "one", landmarks=10_000)
    machine = fitted.model
    z = np.array([r[1:3] for r in rows])
    z = (z - z.mean(0)) / z.std(0)
    y = np.where(np.array([r[3] for r in rows]) == "one", 1.0, -1.0)
    cost = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    f = kernel_svm.decisions(machine.kernel, machine.weights, z)[:, 0]
    alpha = -cost * kernel_svm.rounded_hinge(y * f, kernel_svm.WIDTHS[-1])[1]
    kernel = kernel_svm.rbf(z, z, machine.kernel.gamma)
    assert machine.kernel.gamma == pytest.approx(1 / (2 * z.var()))
    assert kernel @ (alpha * y) + machine.weights[0, -1] == pytest.approx(f, abs=0.01)
    assert abs(alpha @ y) < 0.01
    assert (alpha[y * f > 1.002] == 0).all() and alpha[y * f < 0.998] == pytest.approx(cost[y * f < 0.998])
    scored = {r.id: r for r in classify.scored(frame(spark, rows), fitted).collect()}
    assert [scored[i].score for i in range(120)] == pytest.approx(f.tolist(), abs=1e-6)
    assert all((scored[i].prediction == "one") == (f[i] > 0) for i in range(120))


def test_decisions_agree_better_with_more_landmarks(spark):
    train, test = moons(240, 3), moons(400, 4)
    signs = {}
    for m in (8, 32, 96, 240):
        fitted = classify.train_classifier(frame(spark, train), "label", ["a", "b"], [], "svm_rbf", "one", landmarks=m)
        signs[m] = {r.id: r.prediction for r in classify.scored(frame(spark, test), fitted).collect()}
    rates = {m: np.mean([signs[m][i] == signs[240][i] for i in range(400)]) for m in (8, 32, 96)}
    assert rates[8] > 0.8 and rates[32] > 0.95 and rates[96] > 0.98
    assert np.mean([signs[240][r[0]] == r[3] for r in test]) > 0.8


def test_many_classes(spark):
    rng = np.random.default_rng(5)
    centres = [(0, 0), (4, 0), (0, 4), (4, 4)]
    rows = [(i, *(float(v) for v in rng.normal(centres[i % 4], 0.7)), f"c{i % 4}") for i in range(160)]
    fitted = classify.train_classifier(frame(spark, rows), "label", ["a", "b"], [], "svm_rbf", landmarks=40)
    got = {r.id: r.prediction for r in classify.scored(frame(spark, rows), fitted).collect()}
    assert np.mean([got[r[0]] == r[3] for r in rows]) > 0.95
