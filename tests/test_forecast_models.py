"""Fitted forecast models against densities, loops and objectives written out plainly."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casecurve.operators import arima, evaluate, forecast, piecewise
from casecurve.operators import sarima_exact as exact
from casecurve.plans.retrain import retrain_forecasts, stored_forecast


def frame(spark, named, period="month"):
    rows = []
    for name, values in named.items():
        for i, v in enumerate(values):
            day = dt.date(2000 + i // 12, i % 12 + 1, 1) if period == "month" else dt.date(2024, 1, 1) + dt.timedelta(i)
            rows.append((name, day, float(v)))
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


# -- exact likelihood ---------------------------------------------------------------------------------


def covariance(params, q, season, n, terms=3000):
    """Autocovariance matrix of n values for unit noise, from the noise weights."""
    phi, theta = (p[0] for p in exact.polynomials(np.array([params]), q, season))
    psi = np.zeros(terms)
    lags = np.flatnonzero(phi)
    for j in range(terms):
        psi[j] = (theta[j] if j < len(theta) else 0.0) + sum(phi[i] * psi[j - 1 - i] for i in lags if j > i)
    g = np.array([psi[: terms - h] @ psi[h:] for h in range(n)])
    return g[np.abs(np.subtract.outer(range(n), range(n)))]


def log_density(y, cov):
    n = len(y)
    sigma2 = y @ np.linalg.solve(cov, y) / n
    return -0.5 * (n * np.log(2 * np.pi * sigma2) + n + np.linalg.slogdet(cov)[1]), sigma2


@settings(max_examples=25, deadline=None)
@given(
    st.tuples(*[st.floats(-0.9, 0.9)] * 2, *[st.floats(-2.0, 2.0)] * 2), st.integers(0, 1), st.sampled_from([4, 7, 12]), st.integers(14, 40)
)
def test_likelihood_is_the_joint_normal_density(params, q, season, n):
    params = params if q else (*params[:3], 0.0)
    y = np.random.default_rng(n).normal(0, 3, n)
    found = exact.filtered(y[None], np.array([n]), np.array([params]), q, season)
    loglik, sigma2 = log_density(y, covariance(params, q, season, n))
    assert found.loglik[0] == pytest.approx(loglik, rel=1e-6, abs=1e-6)
    assert found.sigma2[0] == pytest.approx(sigma2, rel=1e-6)


def test_diffuse_likelihood_is_the_density_given_the_first_values():
    """Values of the state-space model with an unknown start, as one joint normal vector."""
    season, n, params = 4, 25, np.array([[0.6, -0.4, 0.3, 0.0]])
    phi, theta = (p[0] for p in exact.polynomials(params, 0, season))
    r = len(phi)
    move = np.zeros((r, r))
    move[:, 0] = phi
    move[np.arange(r - 1), np.arange(1, r)] += 1.0
    # value t = first entry of move^t start + noise of the steps before
    rows, response = [], [theta]
    power = np.eye(r)
    for _ in range(n):
        rows.append(power[0])
        power = power @ move
        response.append(move @ response[-1])
    cov = exact.DIFFUSE * np.array(rows) @ np.array(rows).T
    for a in range(n):
        for b in range(n):
            cov[a, b] += sum(response[a - k][0] * response[b - k][0] for k in range(1, min(a, b) + 1))
    y = np.random.default_rng(8).normal(0, 2, n)
    found = exact.filtered(y[None], np.array([n]), params, 0, season, "diffuse")

    def scaled(k, s2):
        return -0.5 * (k * np.log(2 * np.pi * s2) + np.linalg.slogdet(cov[:k, :k])[1] + y[:k] @ np.linalg.solve(cov[:k, :k], y[:k]) / s2)

    assert found.loglik[0] == pytest.approx(scaled(n, found.sigma2[0]) - scaled(r, found.sigma2[0]), abs=1e-4)


@pytest.mark.parametrize(("order", "q"), [(arima.SERVICE_ORDER, 0), (arima.BACKTEST_ORDER, 1)])
def test_fit_is_never_less_likely_than_the_conditional_one(spark, order, q):
    rng = np.random.default_rng(5)
    named = {f"s{i}": np.cumsum(rng.normal(0, 2 + i, 40 + 7 * i)) + 10 * np.sin(np.arange(40 + 7 * i) / 2) for i in range(6)}
    df = frame(spark, named)
    for initial in ("stationary", "diffuse"):
        fitted = {r.series_id: r for r in exact.fit_sarima_exact(df, order=order, initial=initial).collect()}
        for r in arima.fit_sarima(df, order=order).collect():
            w = np.diff(named[r.series_id]) if order[0] else named[r.series_id]
            start = np.clip([[r.ar, r.sar, r.ma, r.sma]], -0.999, 0.999)
            known = exact.filtered(w[None], np.array([len(w)]), start, q, 12, initial).loglik[0]
            best = fitted[r.series_id]
            assert best.loglik >= known - 1e-6
            assert best.aic == pytest.approx(2 * (4 + q) - 2 * best.loglik)
            # No small step in any coefficient gains: a maximum, not only a better point.
            here = np.array([[best.ar, best.sar, best.ma, best.sma]])
            for k in range(3 + q):
                for step in (-0.02, 0.02):
                    moved = here.copy()
                    moved[0, k] += step
                    if initial == "diffuse" or np.abs(moved[0, :2]).max() < 1:
                        assert exact.filtered(w[None], np.array([len(w)]), moved, q, 12, initial).loglik[0] <= best.loglik + 1e-3


def test_coefficients_may_come_close_to_a_unit_root(spark):
    rng = np.random.default_rng(2)
    walk = np.cumsum(rng.normal(0, 1, 300)) + 40
    fitted = exact.fit_sarima_exact(frame(spark, {"walk": walk})).first()
    assert fitted.ar > 0.99


def test_exact_forecast_goes_on_from_the_best_linear_prediction(spark):
    params, n, steps = (0.5, 0.3, 0.4, 0.0), 50, 8
    y = np.random.default_rng(4).normal(0, 5, n)
    cov = covariance(params, 0, 12, n + steps)
    best = cov[n:, :n] @ np.linalg.solve(cov[:n, :n], y)
    left = cov[n:, n:] - cov[n:, :n] @ np.linalg.solve(cov[:n, :n], cov[:n, n:])
    stored = exact.fit_sarima_exact(frame(spark, {"a": y}), params=params)
    got = exact.predict_sarima_exact(stored, steps).orderBy("step").collect()
    assert [r.yhat for r in got] == pytest.approx(best.tolist())
    half = 1.2815515655446004 * np.sqrt(stored.first().sigma2 * np.diag(left))
    assert [r.yhat_upper - r.yhat for r in got] == pytest.approx(half.tolist(), rel=1e-3)
    assert [r.yhat - r.yhat_lower for r in got] == pytest.approx(half.tolist(), rel=1e-3)


def test_exact_models_of_daily_series(spark):
    rng = np.random.default_rng(3)
    y = 50 + 20 * np.sin(np.arange(90) * 2 * np.pi / 7) + rng.normal(0, 1, 90)
    got = evaluate.forecast_with(frame(spark, {"a": y}, "day"), "sarima_exact_backtest", 7, period="day").orderBy("step").collect()
    assert [r.yhat for r in got] == pytest.approx((50 + 20 * np.sin(np.arange(90, 97) * 2 * np.pi / 7)).tolist(), abs=8)


def test_short_and_constant_series_are_not_fitted(spark):
    df = frame(spark, {"one": [5], "short": range(13), "zero": [0] * 40})
    got = {r.series_id: r for r in exact.fit_sarima_exact(df).collect()}
    assert (got["one"].ar, got["one"].loglik, got["short"].aic) == (0.0, None, None)
    assert got["zero"].sigma2 == pytest.approx(1e-12)


# -- Holt-Winters -------------------------------------------------------------------------------------


def test_derivatives_along_the_recursion():
    rng = np.random.default_rng(1)
    y, n = rng.normal(10, 3, (4, 30)), np.array([30, 30, 17, 5])
    y = np.where(np.arange(30) < n[:, None], y, 0.0)
    weights, begin = rng.uniform(0.1, 0.4, (4, 2)), rng.normal(0, 2, (4, 8))
    _, square, product = forecast._run(y, n, weights, begin, 7, True)
    point = np.concatenate([weights, begin], axis=1)
    for k in range(10):
        up, down = point.copy(), point.copy()
        up[:, k] += 1e-6
        down[:, k] -= 1e-6
        slope = (forecast._run(y, n, up[:, :2], up[:, 2:], 7, False) - forecast._run(y, n, down[:, :2], down[:, 2:], 7, False)) / 4e-6
        assert product[:, k] == pytest.approx(slope, rel=1e-4, abs=1e-4)
    assert (np.linalg.eigvalsh(square) > -1e-6).all()


def test_joint_fit_is_never_worse_than_two_steps(spark):
    rng = np.random.default_rng(9)
    named = {f"s{i}": np.cumsum(rng.normal(0, 1, 20 + 9 * i)) + 5 * np.sin(np.arange(20 + 9 * i) * np.pi / 6) + 30 for i in range(8)}
    named |= {"short": [1, 2, 3], "constant": [4] * 30, "steps": [0] * 20 + [50] * 20}
    df = frame(spark, named)
    two = {r.series_id: r for r in forecast.fit_holt_winters(df, start="estimated").collect()}
    joint = {r.series_id: r for r in forecast.fit_holt_winters(df, start="joint").collect()}
    for name, r in joint.items():
        assert r.sse <= two[name].sse * (1 + 1e-9) + 1e-9
        assert 0 <= r.alpha <= 1 and -1e-12 <= r.gamma <= 1 - r.alpha + 1e-12
    assert sum(r.sse < 0.99 * two[name].sse for name, r in joint.items()) >= 3


def test_the_stored_model_is_the_scored_one(spark, tmp_path):
    rng = np.random.default_rng(7)
    df = frame(spark, {"a": rng.poisson(30, 60), "b": rng.poisson(9, 44)})
    names = ["holt_winters", "sarima", "sarima_exact", "trend_yearly", "linear"]
    params, scores = retrain_forecasts(df, str(tmp_path), names)
    assert set(params) == set(names)
    assert {(r.model, r.series_id) for r in scores.collect()} == {(m, s) for m in names for s in "ab"}
    for name in names:
        again = evaluate.forecast_with(df, name)
        stored = {(r.series_id, r.step): r.yhat for r in stored_forecast(spark, str(tmp_path), name).collect()}
        assert stored == pytest.approx({(r.series_id, r.step): r.yhat for r in again.collect()})
        want = evaluate.holdout_metrics(df, name, min_train=12).collect()
        got = scores.where(f"model = '{name}'").drop("model").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    with pytest.raises(ValueError, match="no parameters"):
        retrain_forecasts(df, str(tmp_path), ["fourier"])


# -- trends with slope changes --------------------------------------------------------------------------


def objective(x, z, y, ridge, scale, weights, delta, v):
    e = y - x @ weights - z @ delta
    prior = np.square(weights / ridge).sum() / 2 + np.abs(delta).sum() / scale + v / (2 * piecewise.NOISE_SCALE**2)
    return len(y) / 2 * np.log(v) + e @ e / (2 * v) + prior


def test_no_other_fit_nearby_is_likelier():
    rng = np.random.default_rng(0)
    n = 70
    t = np.arange(n) / (n - 1)
    x = np.column_stack([np.ones(n), t, piecewise.waves(np.arange(n) + 5, 10, 12.0)])
    z = piecewise.bends(t, piecewise.change_places(n, 25))
    ridge = np.array([5.0, 5.0] + [10.0] * (x.shape[1] - 2))
    y = 0.3 + 0.5 * t - 1.2 * np.maximum(t - 0.5, 0) + 0.1 * np.sin(np.arange(n) * np.pi / 6) + rng.normal(0, 0.05, (6, n))
    y[5] = 0.0
    weights, delta, v = piecewise.solved(x, z, y, ridge, 0.05)
    assert ((delta[:5] != 0).sum(axis=1) <= 8).all() and (delta[:5] != 0).any(axis=1).all()
    for i in range(5):
        best = objective(x, z, y[i], ridge, 0.05, weights[i], delta[i], v[i])
        for _ in range(300):
            size = 10.0 ** rng.uniform(-4, -1)
            moved = delta[i] + rng.normal(0, size, len(delta[i])) * (rng.random(len(delta[i])) < 0.2)
            other = weights[i] + rng.normal(0, size, len(weights[i])) * (rng.random(len(weights[i])) < 0.3)
            assert objective(x, z, y[i], ridge, 0.05, other, moved, v[i] * np.exp(rng.normal(0, size))) >= best - 1e-6


def test_a_bend_is_found_and_followed(spark):
    y = [100 + 5 * min(i, 30) - 4 * max(0, i - 30) for i in range(60)]
    got = evaluate.forecast_with(frame(spark, {"a": y}), "trend_yearly").orderBy("step").collect()
    assert [r.yhat for r in got] == pytest.approx([130 - 4 * h for h in range(-0, 6)], abs=12)


def test_intervals_widen_and_repeat(spark):
    rng = np.random.default_rng(11)
    named = {f"s{i}": 200 + np.cumsum(np.repeat(rng.normal(0, 4, 8), 10)) + rng.normal(0, 2, 80) for i in range(4)}
    df = frame(spark, named)
    widths = {}
    for r in evaluate.forecast_with(df, "trend_yearly", 24).collect():
        widths.setdefault(r.series_id, {})[r.step] = r.yhat_upper - r.yhat_lower
        assert r.yhat_lower < r.yhat < r.yhat_upper
    # The more the slope has changed, the more the interval widens; with hardly any change it is that of the noise.
    assert all(w[24] > 0.85 * w[1] for w in widths.values())
    assert sum(w[24] > 5 * w[1] for w in widths.values()) >= 2
    again = {(r.series_id, r.step): r.yhat_lower for r in evaluate.forecast_with(df.repartition(3), "trend_yearly", 24).collect()}
    assert again == {(r.series_id, r.step): r.yhat_lower for r in evaluate.forecast_with(df, "trend_yearly", 24).collect()}
    flat = [r.yhat_upper - r.yhat_lower for r in evaluate.forecast_with(df, "trend_flat", 24).where("series_id = 's0'").collect()]
    assert max(flat) < 1.35 * min(flat)


def test_intervals_cover_about_their_share(spark):
    """Lines with yearly waves and noise: the 80 % interval holds about that share of the next six values."""
    rng = np.random.default_rng(12)
    months = np.arange(66)
    full = {f"s{i}": 100 + rng.normal() * months + 10 * np.sin(months * np.pi / 6) + rng.normal(0, 5, 66) for i in range(60)}
    got = evaluate.forecast_with(frame(spark, {k: v[:60] for k, v in full.items()}), "trend_yearly").collect()
    inside = [r.yhat_lower <= full[r.series_id][59 + r.step] <= r.yhat_upper for r in got]
    assert 0.7 < np.mean(inside) < 0.9


def test_places_of_changes():
    assert len(piecewise.change_places(1, 25)) == 0 and len(piecewise.change_places(4, 25)) == 2
    places = piecewise.change_places(60, 25)
    assert len(places) == 25 and places[0] > 0 and places[-1] <= 47 / 59


# -- the table function -----------------------------------------------------------------------------------


def test_table_function_in_sql(spark):
    from casecurve.functions.tables import register_table_functions

    register_table_functions(spark)
    rng = np.random.default_rng(21)
    df = frame(spark, {"a": rng.poisson(30, 50), "b": rng.poisson(9, 17), "one": [4]})
    df = df.unionByName(df.limit(1).selectExpr("'b' AS series_id", "CAST(NULL AS DATE) AS ds", "1.0D AS y"))
    df.createOrReplaceTempView("some_series")
    for model in ("flat", "linear", "seasonal_mean", "holt_winters"):
        got = spark.sql(f"""SELECT * FROM series_forecast(
            TABLE(SELECT series_id, 7 AS region, ds, y FROM some_series) PARTITION BY (series_id, region), model => '{model}', steps => 5)""")
        assert got.columns == ["series_id", "region", "ds", "step", "yhat"]
        want = {(r.series_id, r.ds): r.yhat for r in evaluate.forecast_with(df.where("ds IS NOT NULL"), model, 5).collect()}
        assert {(r.series_id, r.ds): r.yhat for r in got.collect()} == pytest.approx(want, rel=1e-6)
    daily = frame(spark, {"a": range(30)}, "day")
    daily.createOrReplaceTempView("daily_series")
    got = spark.sql("SELECT * FROM series_forecast(TABLE(daily_series) PARTITION BY series_id ORDER BY ds, period => 'day')").collect()
    assert [r.yhat for r in got] == pytest.approx(list(range(30, 36)))
    for text, said in (
        ("TABLE(SELECT series_id, ds FROM some_series) PARTITION BY series_id", "needs ds and y"),
        ("TABLE(some_series) PARTITION BY series_id, model => 'none'", "is none of"),
    ):
        with pytest.raises(Exception, match=said):
            spark.sql(f"SELECT * FROM series_forecast({text})").collect()
