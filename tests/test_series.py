from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from casecurve.functions.numbers import whole_cases
from casecurve.functions.risk import risk_grade, z_score
from casecurve.functions.sql import register_functions
from casecurve.functions.text import is_word
from casecurve.operators import baseline, evaluate, risk, series


def monthly(spark, values, series_id="a", start=(2020, 1)):
    year, month = start
    rows = []
    for i, y in enumerate(values):
        m = month - 1 + i
        rows.append((series_id, dt.date(year + m // 12, m % 12 + 1, 1), int(y)))
    return spark.createDataFrame(rows, "series_id string, ds date, y bigint")


def case_rows(spark, days, status="Confirmed", series_id="a"):
    rows = [(series_id, d and dt.datetime.fromisoformat(d), status) for d in days]
    return spark.createDataFrame(rows, "series_id string, event_ts timestamp, status string")


def test_gaps_become_zero_rows(spark):
    cases = case_rows(spark, ["2024-01-05", "2024-04-30", "2024-04-01", None])
    out = series.case_series(cases).orderBy("ds").collect()
    assert [(r.ds.isoformat(), r.y) for r in out] == [("2024-01-01", 1), ("2024-02-01", 0), ("2024-03-01", 0), ("2024-04-01", 2)]


def test_daily_and_weekly_periods(spark):
    cases = case_rows(spark, ["2024-02-28", "2024-03-02"])
    assert series.case_series(cases, period="day").count() == 4
    weeks = series.case_series(case_rows(spark, ["2024-01-01", "2024-01-20"]), period="week").orderBy("ds").collect()
    assert [r.ds.day for r in weeks] == [1, 8, 15]


def test_counts_are_conserved_with_a_hot_series(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("series_id"),
        F.expr("timestamp '2020-01-01' + make_interval(0, 0, 0, cast(id % 900 as int))").alias("event_ts"),
    )
    out = series.case_series(rows, status=None)
    assert out.agg(F.sum("y")).first()[0] == 9000
    gaps = out.groupBy("series_id").agg(F.count("y").alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b"))
    assert gaps.where("n <> months_between(b, a) + 1").count() == 0


def test_status_in_any_casing_and_its_pushable_range(spark):
    df = spark.createDataFrame([("CONFIRMED",), ("confirmed",), ("CoNfIrMeD",), ("conf",), ("Suspected",), (None,)], "s string")
    assert df.where(is_word(F.col("s"), "Confirmed")).count() == 3


def test_partial_tail_is_dropped_on_request(spark):
    cases = case_rows(spark, ["2024-01-05", "2024-02-10", "2024-03-01"])
    out = series.case_series(cases, complete_until="2024-03-10")
    assert out.agg(F.max("ds")).first()[0] == dt.date(2024, 2, 1)


def test_baseline_fallbacks(spark):
    one_month = monthly(spark, [100])
    rows = {r.month: r for r in baseline.seasonal_baseline(one_month).collect()}
    assert (rows[1].mean, rows[1].std, rows[1].n) == (100.0, 25.0, 1)
    assert (rows[2].mean, rows[2].std, rows[2].n) == (100.0, 25.0, 0)
    assert baseline.seasonal_baseline(monthly(spark, [2])).where("month = 1").first().std == 1.0
    trainer = baseline.seasonal_baseline(one_month, fallback="trainer")
    assert trainer.where("month = 1").first().std == 20.0
    assert trainer.where("month = 2").first().std is None


def test_half_even_mean(spark):
    df = monthly(spark, [1387, 1387, 1387, 1388])
    assert baseline.global_baseline(df).first().mean == 1387.2


def test_grades_at_the_boundaries(spark):
    z = [-1.0, 1.99, 2.0, 2.99, 3.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in z], "z double")
    assert [r.g for r in df.select(risk_grade(F.col("z")).alias("g")).collect()] == [
        "Normal", "Normal", "Alert", "Alert", "Critical", None, None,
    ]
    register_functions(spark)
    assert spark.sql("SELECT risk_grade(2.5D), case_z(12D, 10D, 0D)").first()[:] == ("Alert", 2.0)


def test_zero_spread_and_rounding_before_grading(spark):
    df = spark.createDataFrame([(12.0, 10.0, 0.0)], "cases double, mean double, std double")
    assert df.select(z_score(F.col("cases"), F.col("mean"), F.col("std"))).first()[0] == 2.0
    near = spark.createDataFrame([("a", 1.996, 0.0, 1.0)], "series_id string, cases double, mean double, std double")
    assert risk.evaluate_counts(near).first().risk_level == "Normal"
    forecast = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.996)], "series_id string, ds date, predicted_cases double")
    graded = risk.assess_forecast(forecast, near.select("series_id", "mean", "std"))
    assert graded.first().risk_level == "Alert"


def test_whole_cases(spark):
    df = spark.createDataFrame([(-3.2,), (2.5,), (3.5,)], "x double")
    assert [r[0] for r in df.select(whole_cases(F.col("x"))).collect()] == [0, 2, 4]


def test_splits_of_short_series(spark):
    assert series.holdout_split(monthly(spark, range(18)), 6, 12).where("part = 'test'").count() == 0
    assert series.holdout_split(monthly(spark, range(19)), 6, 12).where("part = 'test'").count() == 6
    folds = series.rolling_folds(monthly(spark, range(43))).where("part = 'test'")
    assert [(r.origin, r.n) for r in folds.groupBy("origin").agg(F.count("y").alias("n")).collect()] == [(40, 3)]


def holt_winters_loop(y, alpha, gamma):
    level = np.mean(y[:12])
    season = [v - level for v in y[:12]]
    sse = 0.0
    for t, value in enumerate(y):
        e = value - level - season[t % 12]
        sse += e * e
        level += alpha * e
        season[t % 12] += gamma * e
    return sse, [level + season[(len(y) + h) % 12] for h in range(6)]


def test_holt_winters_against_a_loop(spark):
    rng = np.random.default_rng(1)
    y = (50 + 20 * np.sin(np.arange(40) * np.pi / 6) + rng.normal(0, 3, 40)).round()
    from casecurve.operators import forecast

    df = monthly(spark, y)
    fixed = forecast.fit_holt_winters(df, alpha=0.4, gamma=0.3)
    sse, path = holt_winters_loop(y, 0.4, 0.3)
    assert fixed.first().sse == pytest.approx(sse)
    assert [r.yhat for r in forecast.predict_holt_winters(fixed, 6).orderBy("step").collect()] == pytest.approx(path)
    best = forecast.fit_holt_winters(df).first()
    grid = [holt_winters_loop(y, a / 10, g / 10)[0] for a in range(11) for g in range(11 - a)]
    assert best.sse <= min(grid) + 1e-9
    assert 0 <= best.gamma <= 1 - best.alpha + 1e-9


@pytest.mark.parametrize("model", sorted(evaluate.MODELS))
def test_constant_series_is_forecast_as_that_constant(spark, model):
    out = evaluate.forecast_with(monthly(spark, [40] * 48), model).orderBy("ds").collect()
    assert len(out) == 6 and out[0].ds == dt.date(2024, 1, 1)
    # A model without a constant term decays from the level.
    near = 1 if not model.startswith("sarima") else 4
    assert all(abs(r.predicted_cases - 40) <= near for r in out)


def test_seasonal_models_follow_the_season(spark):
    y = [100 + 50 * np.sin(np.pi * m / 6) for m in range(60)]
    for model in ("fourier", "seasonal_mean", "holt_winters"):
        out = evaluate.forecast_with(monthly(spark, np.round(y)), model).orderBy("ds").collect()
        assert [r.predicted_cases for r in out] == pytest.approx([round(v) for v in y[:6]], abs=2)


def test_sarima_recovers_an_autoregression(spark):
    from casecurve.operators import arima

    rng = np.random.default_rng(3)
    y = [0.0] * 240
    for t in range(1, 240):
        y[t] = 0.7 * y[t - 1] + rng.normal(0, 10)
    rows = [("a", dt.date(2000 + i // 12, i % 12 + 1, 1), float(v)) for i, v in enumerate(y)]
    fitted = arima.fit_sarima(spark.createDataFrame(rows, "series_id string, ds date, y double")).first()
    assert fitted.ar == pytest.approx(0.7, abs=0.2)
    plain = sum((y[t]) ** 2 for t in range(13, 240))
    assert fitted.sse < 0.7 * plain
    assert fitted.aic < 227 * np.log(plain / 227) + 8


def test_short_series_do_not_fail(spark):
    one = monthly(spark, [5])
    mixed = monthly(spark, [5, 7]).unionByName(monthly(spark, [3] * 30, "b"))
    for model in evaluate.MODELS:
        assert evaluate.forecast_with(mixed, model).groupBy("series_id").count().count() == 2
        assert evaluate.forecast_with(one, model).count() == 6


def test_fits_do_not_depend_on_the_series_beside_them(spark):
    rng = np.random.default_rng(6)
    frames = [monthly(spark, rng.integers(10, 90, n), f"s{n}") for n in (20, 37, 80)]
    together = frames[0].unionByName(frames[1]).unionByName(frames[2])
    for model in ("holt_winters", "sarima", "sarima_backtest"):
        alone = {}
        for f in frames:
            alone |= {(r.series_id, r.step): r.yhat for r in evaluate.forecast_with(f, model).collect()}
        both = {(r.series_id, r.step): r.yhat for r in evaluate.forecast_with(together, model).collect()}
        assert both == pytest.approx(alone)


def test_error_metrics_floor_the_denominator(spark):
    df = spark.createDataFrame([("a", 0.0, 3.0)], "series_id string, y double, yhat double")
    out = evaluate.error_metrics(df).first()
    assert (out.mae, out.rmse, out.mape) == (3.0, 3.0, 300.0)


def test_horizon_limits(spark):
    from casecurve.plans.surveillance import check_horizon, summarise

    with pytest.raises(ValueError):
        check_horizon(25)
    with pytest.raises(ValueError):
        summarise(monthly(spark, [1, 2]), months=13)


def test_changepoints_follow_a_break(spark):
    from casecurve.operators.arima import fit_predict_fourier

    # Flat for 40 months, then two more cases each month, with a yearly wave.
    values = [100 + max(0, t - 40) * 2 + 10 * np.sin(2 * np.pi * (t + 1) / 12) for t in range(96)]
    rows = [("a", dt.date(2016 + t // 12, t % 12 + 1, 1), float(v)) for t, v in enumerate(values)]
    rows += [("b", ds, v) for _, ds, v in rows] + [("c", ds, v) for _, ds, v in rows[:30]]
    df = spark.createDataFrame(rows, "series_id string, ds date, y double")
    want = [100 + (t - 40) * 2 + 10 * np.sin(2 * np.pi * (t + 1) / 12) for t in range(96, 102)]
    plain = fit_predict_fourier(df, 6).toPandas().sort_values(["series_id", "step"])
    bent = fit_predict_fourier(df, 6, changepoints=5, penalty=0.01).toPandas().sort_values(["series_id", "step"])
    gap = {name: np.abs(out[out.series_id == "a"].yhat.to_numpy() - want).max() for name, out in (("plain", plain), ("bent", bent))}
    assert gap["bent"] < 4 < gap["plain"]
    assert (bent[bent.series_id == "a"].yhat.to_numpy() == bent[bent.series_id == "b"].yhat.to_numpy()).all()
    assert len(bent[bent.series_id == "c"]) == 6


def test_estimated_start_of_holt_winters(spark):
    from casecurve.operators import forecast

    rng = np.random.default_rng(3)
    wave = rng.normal(0, 20, 12)
    wave -= wave.mean()
    level, season, values = 80.0, wave.copy(), []
    for t in range(48):
        # Errors after the first two years only: the start explains these without any.
        error = rng.normal() if t >= 24 else 0.0
        values.append(level + season[t % 12] + error)
        level += 0.3 * error
        season[t % 12] += 0.2 * error
    df = monthly(spark, values).unionByName(monthly(spark, values[:7], "short"))
    found = {r.series_id: r for r in forecast.fit_holt_winters(df, alpha=0.3, gamma=0.2, start="estimated").collect()}
    plain = {r.series_id: r for r in forecast.fit_holt_winters(df, alpha=0.3, gamma=0.2).collect()}
    assert found["a"].sse <= plain["a"].sse + 1e-9 and found["short"].sse < 1e-9
    searched = {r.series_id: r for r in forecast.fit_holt_winters(df, start="estimated").collect()}
    assert searched["a"].sse < 60 and 0 <= searched["a"].gamma <= 1 - searched["a"].alpha
    with pytest.raises(ValueError):
        forecast.fit_holt_winters(df, start="other")
