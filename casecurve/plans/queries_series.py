"""Named queries: counting, gap filling, baselines, grading and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from casecurve.functions.tables import register_table_functions
from casecurve.operators import arima, baseline, evaluate, forecast, risk, series
from casecurve.operators.sarima_exact import fit_sarima_exact, predict_sarima_exact
from casecurve.plans import incremental, surveillance
from casecurve.plans.registry import GLOBAL, GRADE, LINEITEM, ORACLES, ORDERS, query, scan_cte, seasonal_cte, series_ctes
from casecurve.plans.retrain import retrain_forecasts, stored_forecast
from casecurve.session import saved_table, scratch_path
from casecurve.sources import readers, stores
from casecurve.sources.tables import event_cases, lineitem_cases, order_cases, table


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def orders_monthly(spark, folder):
    return series.case_series(order_cases(spark, folder), word="f")


def orders_saved(spark, folder):
    """The order series as a table, for queries that read it more than once."""
    return saved_table(orders_monthly(spark, folder), "series")


def lineitem_monthly(spark, folder):
    return series.case_series(lineitem_cases(spark, folder), word="f")


@query(f"WITH {ORDERS} SELECT * FROM series")
def monthly_cases(spark, folder):
    return orders_monthly(spark, folder)


@query(f"WITH {LINEITEM} SELECT * FROM li_series")
def monthly_cases_lineitem(spark, folder):
    return lineitem_monthly(spark, folder)


@query("WITH " + series_ctes("events", "event_type", "ts", period="day") + " SELECT * FROM series")
def daily_cases(spark, folder):
    return series.case_series(event_cases(spark, folder), period="day", status=None)


@query("WITH " + series_ctes("orders", "o_orderpriority", "o_orderdate",
                             "lower(o_orderstatus) = 'f' AND o_orderdate < DATE '2001-07-01'") + " SELECT * FROM series")
def monthly_cases_complete(spark, folder):
    return series.case_series(order_cases(spark, folder), word="f", complete_until="2001-07-15")


@query(f"""WITH {ORDERS}, {GLOBAL}
SELECT o.*, s.lo AS first_ds FROM overall o JOIN span s USING (series_id)""")
def global_baseline(spark, folder):
    monthly = orders_saved(spark, folder)
    span = series.series_span(monthly).select("series_id", "first_ds")
    return baseline.global_baseline(monthly).join(span, "series_id")


@query(f"WITH {ORDERS}, {seasonal_cte()} SELECT * FROM seasonal")
def seasonal_baseline(spark, folder):
    return baseline.seasonal_baseline(orders_monthly(spark, folder))


@query(f"WITH {ORDERS}, {seasonal_cte('trainer')} SELECT * FROM seasonal")
def seasonal_baseline_trainer(spark, folder):
    return baseline.seasonal_baseline(orders_monthly(spark, folder), fallback="trainer")


@query(f"""WITH {ORDERS}, {seasonal_cte()}
SELECT series_id, month, mean, std FROM seasonal""")
def seasonal_map_lookup(spark, folder):
    nested = baseline.seasonal_map(baseline.seasonal_baseline(orders_monthly(spark, folder)))
    # Month 13 is not in the map and must be passed over.
    wanted = nested.select("series_id", "seasonal", F.explode(F.sequence(F.lit(1), F.lit(13))).alias("month"))
    found = wanted.withColumn("_level", F.try_element_at("seasonal", F.col("month"))).where("_level is not null")
    return found.select("series_id", "month", "_level.mean", "_level.std")


@query(f"WITH {LINEITEM}, {scan_cte('li_series')} SELECT * FROM scan")
def scan_historical(spark, folder):
    return risk.scan_history(lineitem_monthly(spark, folder))


@query(f"""WITH {ORDERS}, raw AS (
  SELECT series_id, ds, y, avg(y) OVER w AS mu, stddev_samp(y) OVER w AS sd FROM series WINDOW w AS (PARTITION BY series_id)),
z AS (SELECT series_id, ds, y, round_even(mu, 1) AS baseline_mean, round_even(sd, 1) AS baseline_std, (y - mu) / sd AS z FROM raw)
SELECT series_id, ds, y, baseline_mean, baseline_std, round_even(z, 2) AS z_score,
  CASE WHEN z < 1.5::double THEN 'Normal' WHEN z < 2.5::double THEN 'Alert' ELSE 'Critical' END AS risk_level, z >= 1.5::double AS is_anomaly
FROM z""")
def scan_custom_thresholds(spark, folder):
    return risk.scan_history(orders_monthly(spark, folder), grade_on="raw", alert=1.5, critical=2.5)


EVALUATE = f"""
    status AS (
      SELECT series_id, last_ds AS ds, CAST(last_cases AS DOUBLE) AS cases, mean AS baseline_mean,
             CASE WHEN std > 1e-6::double THEN std ELSE 1.0::double END AS baseline_std,
             (last_cases - mean) / (CASE WHEN std > 1e-6::double THEN std ELSE 1.0::double END) AS z
      FROM overall)"""


@query(f"""WITH {ORDERS}, {GLOBAL}, {EVALUATE}
SELECT series_id, ds, cases, baseline_mean, baseline_std, round_even(z, 2) AS z_score,
  {GRADE.format(z='z')} AS risk_level, coalesce(z >= 2, false) AS is_anomaly FROM status""")
def evaluate_latest(spark, folder):
    return surveillance.current_status(orders_monthly(spark, folder))


@query(f"""WITH {ORDERS}, {LINEITEM}, {scan_cte('series', 'a')}, {scan_cte('li_series', 'b')}
SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE is_anomaly ORDER BY ds, series_id""")
def anomaly_table(spark, folder):
    return surveillance.anomaly_table(orders_monthly(spark, folder), lineitem_monthly(spark, folder))


# -- forecasts ----------------------------------------------------------------------------------

FUTURE = """
    future AS (
      SELECT series_id, CAST(h AS INTEGER) AS step, CAST(last_ds + to_months(CAST(h AS INTEGER)) AS DATE) AS ds
      FROM (SELECT series_id, max(ds) AS last_ds, unnest(range(1, 7)) AS h FROM series GROUP BY series_id))"""


def whole(expr: str) -> str:
    return f"CAST(round_even(greatest({expr}, 0.0::double), 0) AS BIGINT)"


SEASONAL_FORECAST = f"""{FUTURE},
    month_means AS (SELECT series_id, month(ds) AS month, avg(y) AS mu FROM series GROUP BY 1, 2),
    means AS (SELECT series_id, avg(y) AS gmu FROM series GROUP BY 1),
    predicted AS (
      SELECT f.series_id, f.ds, f.step, {whole('coalesce(m.mu, g.gmu)')} AS predicted_cases
      FROM future f JOIN means g USING (series_id)
      LEFT JOIN month_means m ON m.series_id = f.series_id AND m.month = month(f.ds))"""

ASSESSED = f"""
    assessed_z AS (
      SELECT p.series_id, p.ds, p.step, p.predicted_cases, round_even(b.mean, 1) AS baseline_mean,
             round_even(CASE WHEN b.std > 1e-6::double THEN b.std ELSE 1.0::double END, 1) AS baseline_std,
             round_even((p.predicted_cases - b.mean) / (CASE WHEN b.std > 1e-6::double THEN b.std ELSE 1.0::double END), 2) AS z_score
      FROM predicted p JOIN seasonal b ON b.series_id = p.series_id AND b.month = month(p.ds)),
    assessed AS (
      SELECT *, {GRADE.format(z='z_score')} AS risk_level, coalesce(z_score >= 2, false) AS is_anomaly FROM assessed_z)"""


@query(f"WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST}, {ASSESSED} SELECT * FROM assessed")
def surveillance_summary(spark, folder):
    return surveillance.summarise(orders_monthly(spark, folder), months=6, model="seasonal_mean").forecast


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST.replace('range(1, 7)', 'range(1, 25)')}, {ASSESSED}
SELECT * FROM assessed WHERE series_id = '1-URGENT'""")
def disease_forecast(spark, folder):
    return surveillance.disease_forecast(orders_monthly(spark, folder), "1-URGENT", "seasonal_mean", 24)


@query(f"""WITH {ORDERS}, {GLOBAL}, z AS (
  SELECT s.series_id, s.ds, s.y AS predicted_cases, o.mean AS baseline_mean, round_even(o.std, 1) AS baseline_std,
         round_even((s.y - o.mean) / o.std, 2) AS z_score FROM series s JOIN overall o USING (series_id))
SELECT *, {GRADE.format(z='z_score')} AS risk_level, coalesce(z_score >= 2, false) AS is_anomaly FROM z""")
def assess_forecast_global(spark, folder):
    monthly = orders_saved(spark, folder)
    as_forecast = monthly.withColumnRenamed("y", "predicted_cases")
    return risk.assess_forecast(as_forecast, baseline.global_baseline(monthly))


# Every future month at the series' highest count, which the month-of-year levels then grade.
ALERT_SOURCE = f"""{FUTURE},
    predicted AS (
      SELECT f.series_id, f.ds, f.step, CAST(g.top AS BIGINT) AS predicted_cases
      FROM future f JOIN (SELECT series_id, max(y) AS top FROM series GROUP BY 1) g USING (series_id))"""


def peak_alerts(spark, folder):
    """Every future month at the series' highest count: a forecast that does raise alerts."""
    monthly = orders_saved(spark, folder)
    top = monthly.groupBy("series_id").agg(F.max("y").alias("predicted_cases"), F.max("ds").alias("last_ds"))
    peak = series.future_periods(top, 6).select("series_id", "ds", "step", "predicted_cases")
    return risk.assess_forecast(peak, baseline.global_baseline(monthly), baseline.seasonal_baseline(monthly))


@query(f"WITH {ORDERS}, {seasonal_cte()}, {ALERT_SOURCE}, {ASSESSED} SELECT * FROM assessed")
def assess_forecast_seasonal(spark, folder):
    return peak_alerts(spark, folder)


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {ALERT_SOURCE}, {ASSESSED}
SELECT series_id AS disease, 'Surveillance Region' AS region, risk_level, round_even(z_score, 3) AS z_score,
  printf('%s outbreak alert for %s: %d cases (Z=%.2f).', series_id, strftime(ds, '%Y-%m-%d'), predicted_cases, z_score) AS alert_message,
  false AS is_resolved
FROM assessed WHERE is_anomaly""")
def alert_messages(spark, folder):
    return surveillance.alert_rows(peak_alerts(spark, folder), "Surveillance Region")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {ALERT_SOURCE}, {ASSESSED}
SELECT series_id, ds, predicted_cases, risk_level, z_score FROM assessed WHERE is_anomaly
ORDER BY CASE WHEN lower(risk_level) = 'critical' THEN 0 ELSE 1 END, ds, series_id LIMIT 3""")
def worst_alerts(spark, folder):
    alerts = risk.anomalies(peak_alerts(spark, folder))
    return surveillance.worst_first(alerts, 3).select("series_id", "ds", "predicted_cases", "risk_level", "z_score")


# The urgent series by its overall level, all others by month of year.
MIXED_MODELS = {"1-URGENT": "flat"}
MIXED_FORECAST = SEASONAL_FORECAST.replace("coalesce(m.mu, g.gmu)", "CASE WHEN f.series_id = '1-URGENT' THEN g.gmu ELSE coalesce(m.mu, g.gmu) END")
MIXED_NAME = "CASE WHEN series_id = '1-URGENT' THEN 'flat' ELSE 'seasonal_mean' END"


def mixed_forecast(spark, folder):
    names = {p: MIXED_MODELS.get(p, "seasonal_mean") for p in PRIORITIES}
    return surveillance.summarise(orders_monthly(spark, folder), months=6, model=names).forecast


@query(f"WITH {ORDERS}, {seasonal_cte()}, {MIXED_FORECAST}, {ASSESSED} SELECT *, {MIXED_NAME} AS model FROM assessed")
def surveillance_summary_mixed(spark, folder):
    """A run in which one series has another model than the rest."""
    return mixed_forecast(spark, folder)


DAILY_FUTURE = """
    future AS (
      SELECT series_id, CAST(h AS INTEGER) AS step, CAST(last_ds + to_days(CAST(h AS INTEGER)) AS DATE) AS ds
      FROM (SELECT series_id, max(ds) AS last_ds, unnest(range(1, 15)) AS h FROM series GROUP BY series_id))"""


@query(f"""WITH {series_ctes('events', 'event_type', 'ts', period='day')}, {DAILY_FUTURE},
idx AS (SELECT series_id, CAST(y AS DOUBLE) AS y, CAST(date_diff('day', DATE '1970-01-05', ds) AS DOUBLE) AS t FROM series),
fit AS (SELECT series_id, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM idx GROUP BY 1)
SELECT f.series_id, f.ds, f.step, {whole("a + b * date_diff('day', DATE '1970-01-05', f.ds)")} AS predicted_cases
FROM future f JOIN fit USING (series_id)""")
def forecast_daily(spark, folder):
    """A forecast of daily series: two weeks of days."""
    daily = series.case_series(event_cases(spark, folder), period="day", status=None)
    return evaluate.forecast_with(daily, "linear", 14, period="day").select("series_id", "ds", "step", "predicted_cases")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST}, {ASSESSED}
SELECT series_id AS disease, ds AS forecast_month, predicted_cases, round_even(z_score, 3) AS z_score, risk_level,
  round_even(baseline_mean, 2) AS baseline_mean, round_even(baseline_std, 2) AS baseline_std, 'seasonal_mean' AS model_name
FROM assessed""")
def forecast_records(spark, folder):
    graded = surveillance.graded_forecast(orders_monthly(spark, folder), "seasonal_mean")
    return surveillance.forecast_records(graded, "seasonal_mean")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST}, {ASSESSED},
alerts AS (SELECT series_id AS disease, 'Surveillance Region' AS region, risk_level, z_score FROM assessed WHERE is_anomaly)
SELECT * FROM alerts UNION ALL
SELECT 'Drill', 'All regions', 'Alert', 2.35::double WHERE (SELECT count(*) FROM alerts) = 0""")
def alerts_or_drill(spark, folder):
    natural = surveillance.summarise(orders_monthly(spark, folder), model="seasonal_mean").alerts
    return surveillance.alerts_or_drill(natural).select("disease", "region", "risk_level", "z_score")


@query(f"""WITH {ORDERS}, {seasonal_cte()}, {SEASONAL_FORECAST}, {ASSESSED}
SELECT 'intakes_logged' AS tile, count(*) AS value FROM orders
UNION ALL SELECT 'next_forecast:' || series_id, min_by(predicted_cases, ds) FROM assessed GROUP BY series_id
UNION ALL SELECT 'active_alerts', count(*) FILTER (is_anomaly) FROM assessed""")
def dashboard_tiles(spark, folder):
    graded = surveillance.graded_forecast(orders_monthly(spark, folder), "seasonal_mean")
    return surveillance.dashboard_tiles(order_cases(spark, folder), graded)


@query(f"""WITH {ORDERS}, {SEASONAL_FORECAST}
SELECT ds, {', '.join(f"""max(predicted_cases) FILTER (series_id = '{p}') AS "{p}" """ for p in PRIORITIES)} FROM predicted GROUP BY ds""")
def forecast_pivot(spark, folder):
    predicted = evaluate.forecast_with(orders_monthly(spark, folder), "seasonal_mean")
    return series.wide(predicted, "predicted_cases")


_Z = "1.2815515655446004::double"


@query(f"""WITH {ORDERS}, {FUTURE},
fit AS (SELECT series_id, avg(y) AS mu, stddev_pop(y) AS sigma FROM series GROUP BY 1)
SELECT f.series_id, f.ds, f.step, {whole('mu')} AS predicted_cases, round_even(mu, 4) AS yhat,
  round_even(mu - {_Z} * sigma, 4) AS yhat_lower, round_even(mu + {_Z} * sigma, 4) AS yhat_upper
FROM future f JOIN fit USING (series_id)""")
def forecast_flat(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "flat"))


@query(f"""WITH {ORDERS}, {FUTURE},
idx AS (SELECT series_id, CAST(y AS DOUBLE) AS y, CAST(year(ds) * 12 + month(ds) AS DOUBLE) AS t FROM series),
fit AS (SELECT series_id, regr_slope(y, t) AS b, regr_intercept(y, t) AS a,
  sqrt(greatest(regr_syy(y, t) - regr_slope(y, t) * regr_sxy(y, t), 0.0::double) / count(*)) AS sigma FROM idx GROUP BY 1),
p AS (SELECT f.series_id, f.ds, f.step, a + b * (year(f.ds) * 12 + month(f.ds)) AS yhat, sigma FROM future f JOIN fit USING (series_id))
SELECT series_id, ds, step, {whole('yhat')} AS predicted_cases, round_even(yhat, 4) AS yhat,
  round_even(yhat - {_Z} * sigma, 4) AS yhat_lower, round_even(yhat + {_Z} * sigma, 4) AS yhat_upper FROM p""")
def forecast_linear(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "linear"))


def _rounded(predicted, digits=4):
    return predicted.withColumns({c: F.bround(c, digits) for c in ("yhat", "yhat_lower", "yhat_upper") if c in predicted.columns})


@query(f"""WITH RECURSIVE {ORDERS}, {FUTURE},
obs AS (SELECT series_id, list(CAST(y AS DOUBLE) ORDER BY ds) AS v, CAST(count(*) AS INTEGER) AS n FROM series GROUP BY 1),
fold AS (
  SELECT series_id, v, n, 0 AS t, list_avg(v[1:12]) AS level,
    list_transform(v[1:12], lambda x: x - list_avg(v[1:12])) AS season, 0.0::double AS sse FROM obs
  UNION ALL
  SELECT series_id, v, n, t + 1, level + 0.3::double * (v[t + 1] - level - season[t % 12 + 1]),
    list_transform(range(1, 13), lambda i: CASE WHEN i = t % 12 + 1
      THEN season[i] + 0.2::double * (v[t + 1] - level - season[i]) ELSE season[i] END),
    sse + (v[t + 1] - level - season[t % 12 + 1]) ** 2
  FROM fold WHERE t < n),
fit AS (SELECT * FROM fold WHERE t = n)
SELECT f.series_id, f.ds, f.step, round_even(level + season[(n + f.step - 1) % 12 + 1], 4) AS yhat, round_even(sse, 3) AS sse
FROM future f JOIN fit USING (series_id)""")
def holt_winters_fixed(spark, folder):
    params = forecast.fit_holt_winters(orders_monthly(spark, folder), alpha=0.3, gamma=0.2)
    params = saved_table(params, "params")
    predicted = forecast.predict_holt_winters(params, 6)
    return _rounded(predicted.join(params.select("series_id", F.bround("sse", 3).alias("sse")), "series_id"))


def _by_table_function(spark, monthly, arguments):
    """Plain SQL over a view of the series."""
    register_table_functions(spark)
    monthly.createOrReplaceTempView("case_series")
    return spark.sql(f"""
        SELECT series_id, ds, step, bround(yhat, 4) AS yhat
        FROM series_forecast(TABLE(SELECT series_id, ds, y FROM case_series) PARTITION BY series_id ORDER BY ds, {arguments})""")


@query(f"SELECT series_id, ds, step, yhat FROM ({ORACLES['forecast_linear']})")
def forecast_linear_table(spark, folder):
    """The same line by the table function in SQL."""
    return _by_table_function(spark, orders_monthly(spark, folder), "model => 'linear', steps => 6")


@query(f"SELECT series_id, ds, step, yhat FROM ({ORACLES['holt_winters_fixed']})")
def holt_winters_table(spark, folder):
    return _by_table_function(spark, orders_monthly(spark, folder), "model => 'holt_winters', alpha => 0.3D, gamma => 0.2D")


@query()
def holt_winters_fit(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "holt_winters"))


@query(f"""WITH RECURSIVE {ORDERS}, {FUTURE},
obs AS (SELECT series_id, list(CAST(y AS DOUBLE) ORDER BY ds) AS v, CAST(count(*) AS INTEGER) AS n FROM series GROUP BY 1),
fold AS (
  SELECT series_id, v, n, 13 AS t, list_transform(range(1, 14), lambda i: 0.0::double) AS e, 0.0::double AS sse FROM obs
  UNION ALL
  SELECT series_id, CASE WHEN t < n THEN v ELSE list_append(v, p) END, n, t + 1,
    list_append(e, CASE WHEN t < n THEN v[t + 1] - p ELSE 0.0::double END), sse + CASE WHEN t < n THEN (v[t + 1] - p) ** 2 ELSE 0 END
  FROM (SELECT *, 0.5::double * v[t] + 0.3::double * v[t - 11] - 0.15::double * v[t - 12] + 0.2::double * e[t] AS p FROM fold WHERE t < n + 6)),
fit AS (SELECT * FROM fold WHERE t = n + 6)
SELECT f.series_id, f.ds, f.step, round_even(v[n + f.step], 4) AS yhat, round_even(sse, 3) AS sse,
  round_even((n - 13) * ln(greatest(sse, 1e-12::double) / (n - 13)) + 8, 3) AS aic FROM future f JOIN fit USING (series_id)""")
def sarima_fixed(spark, folder):
    params = saved_table(arima.fit_sarima(orders_monthly(spark, folder), params=(0.5, 0.3, 0.2, 0.0)), "params")
    predicted = arima.predict_sarima(params, 6)
    fit = params.select("series_id", F.bround("sse", 3).alias("sse"), F.bround("aic", 3).alias("aic"))
    return _rounded(predicted.join(fit, "series_id"))


@query(f"""WITH RECURSIVE {ORDERS}, {FUTURE},
gaps AS (SELECT series_id, ds, y, CAST(y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS DOUBLE) AS w FROM series),
obs AS (SELECT series_id, list(w ORDER BY ds) FILTER (w IS NOT NULL) AS v, CAST(count(w) AS INTEGER) AS n, CAST(max_by(y, ds) AS DOUBLE) AS last_y FROM gaps GROUP BY 1),
fold AS (
  SELECT series_id, v, n, last_y, 13 AS t, list_transform(range(1, 14), lambda i: 0.0::double) AS e, 0.0::double AS sse FROM obs
  UNION ALL
  SELECT series_id, CASE WHEN t < n THEN v ELSE list_append(v, p) END, n, last_y, t + 1,
    list_append(e, CASE WHEN t < n THEN v[t + 1] - p ELSE 0.0::double END), sse + CASE WHEN t < n THEN (v[t + 1] - p) ** 2 ELSE 0 END
  FROM (SELECT *, 0.4::double * v[t] + 0.2::double * v[t - 11] - 0.08::double * v[t - 12]
          - 0.3::double * e[t] + 0.1::double * e[t - 11] - 0.03::double * e[t - 12] AS p FROM fold WHERE t < n + 6)),
fit AS (SELECT * FROM fold WHERE t = n + 6)
SELECT f.series_id, f.ds, f.step, round_even(last_y + list_sum(v[n + 1:n + f.step]), 4) AS yhat, round_even(sse, 3) AS sse
FROM future f JOIN fit USING (series_id)""")
def sarima_backtest_fixed(spark, folder):
    fixed = arima.fit_sarima(orders_monthly(spark, folder), order=arima.BACKTEST_ORDER, params=(0.4, 0.2, -0.3, 0.1))
    params = saved_table(fixed, "params")
    predicted = arima.predict_sarima(params, 6)
    return _rounded(predicted.join(params.select("series_id", F.bround("sse", 3).alias("sse")), "series_id"))

def durbin_levinson(psi: str, phi_past: str) -> str:
    """CTEs ``best(k, phi, v)``: weights of the best prediction from k values and its variance, for unit noise.

    The autocovariances come from 800 noise weights, so no state space is involved. ``phi_past`` gives
    the purely autoregressive weights ``a[j + 1]``, ``psi`` those of the noise at ``i`` from them.
    """
    return f"""
pure AS (SELECT list_transform(range(800), lambda j: {phi_past}) AS a),
noise AS (SELECT list_transform(range(1, 801), lambda i: {psi}) AS p FROM pure),
cov AS MATERIALIZED (SELECT list_transform(range(120), lambda h: list_dot_product(p[1:800 - h], p[h + 1:800])) AS g FROM noise),
best AS (
  SELECT 0 AS k, []::DOUBLE[] AS phi, g[1] AS v, g FROM cov
  UNION ALL
  SELECT k + 1, list_append(CASE WHEN k = 0 THEN [] ELSE list_transform(range(1, k + 1), lambda i: phi[i] - c * phi[k + 1 - i]) END, c), v * (1 - c * c), g
  FROM (SELECT *, (g[k + 2] - CASE WHEN k = 0 THEN 0 ELSE list_dot_product(phi, list_reverse(g[2:k + 1])) END) / v AS c FROM best WHERE k < 110))"""


LIKELIHOOD = """
obs AS (SELECT series_id, list(w ORDER BY ds) AS v, CAST(count(*) AS INTEGER) AS n FROM (SELECT * FROM values_of WHERE w IS NOT NULL) GROUP BY 1),
errors AS (
  SELECT series_id, n, o.v[k + 1] - CASE WHEN k = 0 THEN 0 ELSE list_dot_product(b.phi, list_reverse(o.v[1:k])) END AS e, b.v AS f
  FROM obs o JOIN best b ON k < n),
fit AS (
  SELECT series_id, n, sum(e * e / f) / n AS sigma2, -0.5::double * (n * (ln(2 * pi() * sum(e * e / f) / n) + 1) + sum(ln(f))) AS loglik
  FROM errors GROUP BY series_id, n),
ahead AS (
  SELECT series_id, n, v, 0 AS step FROM obs
  UNION ALL
  SELECT a.series_id, n, list_append(a.v, list_dot_product(b.phi, list_reverse(a.v))), step + 1
  FROM ahead a JOIN best b ON b.k = n + step WHERE step < 6)"""


@query(f"""WITH RECURSIVE {ORDERS}, {FUTURE},
{durbin_levinson("a[i] + CASE WHEN i > 1 THEN 0.2::double * a[i - 1] ELSE 0 END",
                 "list_sum(list_transform(range(j // 12 + 1), lambda k: 0.3::double ** k * 0.5::double ** (j - 12 * k)))")},
values_of AS (SELECT series_id, ds, CAST(y AS DOUBLE) AS w FROM series), {LIKELIHOOD}
SELECT f.series_id, f.ds, f.step, round_even(a.v[a.n + f.step], 3) AS yhat,
  round_even(1.2815515655446004::double * sqrt(sigma2 * list_dot_product(p[1:f.step], p[1:f.step])), 3) AS half_width,
  round_even(sigma2, 4) AS sigma2, round_even(loglik, 4) AS loglik, round_even(8 - 2 * loglik, 4) AS aic
FROM future f JOIN fit USING (series_id) JOIN ahead a ON a.series_id = f.series_id AND a.step = 6, noise""")
def sarima_exact_fixed(spark, folder):
    """Exact likelihood and forecast for given coefficients; the SQL goes by best linear prediction instead of a filter."""
    return _exact_fixed(spark, folder, arima.SERVICE_ORDER, (0.5, 0.3, 0.2, 0.0))


@query(f"""WITH RECURSIVE {ORDERS}, {FUTURE},
{durbin_levinson("a[i] + CASE WHEN i > 1 THEN -0.3::double * a[i - 1] ELSE 0 END + CASE WHEN i > 12 THEN 0.1::double * a[i - 12] ELSE 0 END"
                 " + CASE WHEN i > 13 THEN -0.03::double * a[i - 13] ELSE 0 END",
                 "list_sum(list_transform(range(j // 12 + 1), lambda k: 0.2::double ** k * 0.4::double ** (j - 12 * k)))")},
values_of AS (SELECT series_id, ds, CAST(y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS DOUBLE) AS w FROM series), {LIKELIHOOD},
lasts AS (SELECT series_id, CAST(max_by(y, ds) AS DOUBLE) AS last_y FROM series GROUP BY 1),
summed AS (SELECT list_transform(range(1, 7), lambda i: list_sum(p[1:i])) AS p FROM noise)
SELECT f.series_id, f.ds, f.step, round_even(last_y + list_sum(a.v[a.n + 1:a.n + f.step]), 3) AS yhat,
  round_even(1.2815515655446004::double * sqrt(sigma2 * list_dot_product(p[1:f.step], p[1:f.step])), 3) AS half_width,
  round_even(sigma2, 4) AS sigma2, round_even(loglik, 4) AS loglik, round_even(10 - 2 * loglik, 4) AS aic
FROM future f JOIN fit USING (series_id) JOIN ahead a ON a.series_id = f.series_id AND a.step = 6 JOIN lasts l ON l.series_id = f.series_id, summed""")
def sarima_exact_backtest_fixed(spark, folder):
    return _exact_fixed(spark, folder, arima.BACKTEST_ORDER, (0.4, 0.2, -0.3, 0.1))


def _exact_fixed(spark, folder, order, coefficients):
    params = saved_table(fit_sarima_exact(orders_monthly(spark, folder), order=order, params=coefficients), "params")
    predicted = predict_sarima_exact(params, 6)
    fit = params.select("series_id", F.bround("sigma2", 4).alias("sigma2"), F.bround("loglik", 4).alias("loglik"), F.bround("aic", 4).alias("aic"))
    half = F.bround(F.col("yhat_upper") - F.col("yhat"), 3).alias("half_width")
    return predicted.join(fit, "series_id").select("series_id", "ds", "step", F.bround("yhat", 3).alias("yhat"), half, "sigma2", "loglik", "aic")


@query()
def sarima_exact(spark, folder):
    """Fitted coefficients, log-likelihood and AIC, beside those of the conditional fit."""
    monthly = orders_saved(spark, folder)
    fit = fit_sarima_exact(monthly).select("series_id", "n", *[F.bround(c, 3).alias(c) for c in ("ar", "sar", "ma", "sigma2", "loglik", "aic")])
    names = ("ar", "sar", "ma", "aic")
    conditional = arima.fit_sarima(monthly).select("series_id", *[F.bround(c, 3).alias(f"conditional_{c}") for c in names])
    return fit.join(conditional, "series_id")


@query()
def sarima_exact_forecast(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "sarima_exact"))


@query()
def sarima_diffuse_forecast(spark, folder):
    """The service order from an unknown start, no coefficient bounded."""
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "sarima_diffuse"))


@query()
def sarima_forecast(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "sarima"))


@query()
def sarima_backtest_order(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "sarima_backtest"))


@query()
def fourier_forecast(spark, folder):
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "fourier"))


@query()
def trend_yearly_forecast(spark, folder):
    """Line with up to 25 slope changes and yearly waves."""
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "trend_yearly"))


@query()
def trend_changes_forecast(spark, folder):
    """Line with up to 5 small slope changes."""
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "trend_changes"))


@query()
def trend_flat_forecast(spark, folder):
    """A level, with an interval of drawn noise."""
    return _rounded(evaluate.forecast_with(orders_monthly(spark, folder), "trend_flat"))


@query()
def trend_parameters(spark, folder):
    """Level, slope and noise of each series' trend, and how many of its slope changes are not zero."""
    params = evaluate.halves("trend_yearly").fit(orders_monthly(spark, folder), ["series_id"], "month")
    scaled = [F.bround(F.col("scale") * F.col(c), 3).alias(c) for c in ("level", "slope", "sigma")]
    return params.select("series_id", *scaled, F.size(F.filter("changes", lambda d: d != 0)).alias("n_changes"))


@query()
def surveillance_summary_fitted(spark, folder):
    return surveillance.summarise(orders_monthly(spark, folder), months=6, model="holt_winters").forecast


# -- splits and evaluation ----------------------------------------------------------------------


@query(f"""WITH {ORDERS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS p, count(*) OVER (PARTITION BY series_id) AS n FROM series)
SELECT series_id, ds, y, CASE WHEN p <= 6 AND n > 18 THEN 'test' ELSE 'train' END AS part FROM r""")
def holdout_split(spark, folder):
    return series.holdout_split(orders_monthly(spark, folder), 6, min_train=12)


@query(f"""WITH {ORDERS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS p, count(*) OVER (PARTITION BY series_id) AS n FROM series)
SELECT series_id, ds, y, CASE WHEN p <= (n * 80) // 100 THEN 'train' ELSE 'test' END AS part FROM r""")
def prefix_split(spark, folder):
    return series.prefix_split(orders_monthly(spark, folder), 80)


FOLDS = """
    r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS p, count(*) OVER (PARTITION BY series_id) AS n FROM series),
    folds AS (
      SELECT series_id, ds, y, CAST(origin AS INTEGER) AS origin, CASE WHEN p <= origin THEN 'train' ELSE 'test' END AS part
      FROM (SELECT *, unnest([40, 46, 52]) AS origin FROM r) WHERE p <= origin + 6 AND n > origin)"""


@query(f"WITH {ORDERS}, {FOLDS} SELECT * FROM folds")
def rolling_origin_folds(spark, folder):
    return series.rolling_folds(orders_monthly(spark, folder))


@query(f"""WITH {ORDERS}, r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS p FROM series)
SELECT series_id, ds, y FROM r WHERE p <= 12""")
def latest_periods(spark, folder):
    return series.last_rows(orders_monthly(spark, folder), 12)


def metrics_sql(compared: str, keys: str) -> str:
    return f"""SELECT {keys}, count(*) AS n_test, round_even(avg(abs(y - yhat)), 2) AS mae,
  round_even(sqrt(avg((y - yhat) * (y - yhat))), 2) AS rmse,
  round_even(avg(abs(y - yhat) / greatest(y, 1.0::double)) * 100.0::double, 2) AS mape FROM {compared} GROUP BY {keys}"""


@query(f"""WITH {ORDERS},
split AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) <= 6 AS test FROM series),
fit AS (SELECT series_id, month(ds) AS m, avg(y) AS mu FROM split WHERE NOT test GROUP BY 1, 2),
compared AS (SELECT s.series_id, CAST(s.y AS DOUBLE) AS y, mu AS yhat FROM split s JOIN fit f ON f.series_id = s.series_id AND f.m = month(s.ds) WHERE test)
{metrics_sql('compared', 'series_id')}""")
def holdout_metrics_seasonal(spark, folder):
    return evaluate.holdout_metrics(orders_monthly(spark, folder), "seasonal_mean")


BACKTEST = f"""{FOLDS},
    fit AS (SELECT series_id, origin, avg(y) AS mu FROM folds WHERE part = 'train' GROUP BY 1, 2),
    compared AS (
      SELECT t.series_id, t.origin, CAST(t.y AS DOUBLE) AS y, mu AS yhat
      FROM folds t JOIN fit f ON f.series_id = t.series_id AND f.origin = t.origin WHERE part = 'test')"""


@query(f"WITH {ORDERS}, {BACKTEST} {metrics_sql('compared', 'series_id, origin')}")
def backtest_metrics_flat(spark, folder):
    return evaluate.rolling_metrics(orders_monthly(spark, folder), "flat")


@query(f"""WITH {ORDERS}, {BACKTEST}, per_fold AS ({metrics_sql('compared', 'series_id, origin')})
SELECT series_id, count(*) AS n_folds, round_even(avg(mae), 2) AS mae, round_even(avg(rmse), 2) AS rmse FROM per_fold GROUP BY 1""")
def backtest_average_flat(spark, folder):
    return evaluate.average_metrics(evaluate.rolling_metrics(orders_monthly(spark, folder), "flat"))


@query()
def holdout_metrics_holt_winters(spark, folder):
    return evaluate.holdout_metrics(orders_monthly(spark, folder), "holt_winters", min_train=12)


@query()
def holdout_metrics_sarima(spark, folder):
    return evaluate.holdout_metrics(orders_monthly(spark, folder), "sarima")


@query(f"""WITH {ORDERS},
split AS (SELECT *, p <= 6 AND n > 18 AS test, CAST(year(ds) * 12 + month(ds) AS DOUBLE) AS t
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS p, count(*) OVER (PARTITION BY series_id) AS n FROM series)),
by_month AS (SELECT series_id, month(ds) AS m, avg(y) AS mu FROM split WHERE NOT test GROUP BY 1, 2),
line AS (SELECT series_id, avg(y) AS mu, regr_slope(CAST(y AS DOUBLE), t) AS b, regr_intercept(CAST(y AS DOUBLE), t) AS a FROM split WHERE NOT test GROUP BY 1),
compared AS (
  SELECT 'flat' AS model, series_id, CAST(y AS DOUBLE) AS y, greatest(mu, 0.0::double) AS yhat FROM split JOIN line USING (series_id) WHERE test
  UNION ALL SELECT 'linear', series_id, CAST(y AS DOUBLE), greatest(a + b * t, 0.0::double) FROM split JOIN line USING (series_id) WHERE test
  UNION ALL SELECT 'seasonal_mean', s.series_id, CAST(s.y AS DOUBLE), m.mu FROM split s JOIN by_month m ON m.series_id = s.series_id AND m.m = month(s.ds) WHERE test)
{metrics_sql('compared', 'model, series_id')}""")
def retrain_closed_form(spark, folder):
    """Hold-out scores of a retraining run over the models that SQL can fit."""
    names = ("flat", "linear", "seasonal_mean")
    return retrain_forecasts(orders_monthly(spark, folder), scratch_path(spark, "models"), names)[1]


@query(f"""WITH {ORDERS}, {SEASONAL_FORECAST} SELECT * FROM predicted""")
def forecast_from_store(spark, folder):
    """Forecasts from the parameters that a retraining run stored."""
    path = scratch_path(spark, "models")
    retrain_forecasts(orders_monthly(spark, folder), path, ("seasonal_mean",))
    return stored_forecast(spark, path, "seasonal_mean").select("series_id", "ds", "step", "predicted_cases")


@query()
def holdout_metrics_trend(spark, folder):
    """The three trend models on the last six months."""
    monthly = orders_saved(spark, folder)
    lines = [evaluate.holdout_metrics(monthly, m).select(F.lit(m).alias("model"), "*") for m in ("trend_yearly", "trend_changes", "trend_flat")]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


@query()
def holdout_metrics_sarima_exact(spark, folder):
    return evaluate.holdout_metrics(orders_monthly(spark, folder), "sarima_exact")


@query()
def backtest_metrics_sarima_exact(spark, folder):
    return evaluate.rolling_metrics(orders_monthly(spark, folder), "sarima_exact_backtest")


@query()
def backtest_metrics_sarima(spark, folder):
    return evaluate.rolling_metrics(orders_monthly(spark, folder), "sarima_backtest")


# -- counts kept up to date -------------------------------------------------------------------------


def _counted_in_steps(spark, folder):
    """Orders in three parts: one is first written in part, then another comes, then the first is replaced."""
    landing, ledger = scratch_path(spark, "landing"), scratch_path(spark, "ledger")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    part = [orders.where(F.col("o_orderkey") % 3 == i) for i in range(3)]

    def cases(raw):
        named = raw.withColumns({"series_id": F.col("o_orderpriority"), "event_ts": F.col("o_orderdate")})
        return series.confirmed_cases(named, "o_orderstatus", "f")

    runs = []
    for step in ({"a": part[0], "b": part[1].where("o_orderstatus <> 'O'").unionByName(part[2].limit(50))}, {"c": part[2]}, {"b": part[1]}):
        for name, rows in step.items():
            rows.write.mode("overwrite").parquet(f"{landing}/{name}")
        runs.append(incremental.update_counts(spark, landing, ledger, cases))
    return ledger, runs


@query(f"WITH {ORDERS} SELECT * FROM series")
def counts_kept_up_to_date(spark, folder):
    return incremental.counted_series(spark, _counted_in_steps(spark, folder)[0])


@query(f"WITH {ORDERS}, {GLOBAL} SELECT * FROM overall")
def baseline_kept_up_to_date(spark, folder):
    return incremental.current_baselines(spark, _counted_in_steps(spark, folder)[0])[0]


# -- files ------------------------------------------------------------------------------------------


@query(f"WITH {series_ctes('orders', chr(39) + 'all' + chr(39), 'o_orderdate', 'lower(o_orderstatus) = ' + chr(39) + 'f' + chr(39))} SELECT * FROM series")
def line_list_from_csv(spark, folder):
    """A line list written as CSV under other names, read back as text and counted."""
    path = scratch_path(spark, "line_list")
    orders = table(spark, folder, "orders")
    dates = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate").cast("string")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    named = orders.select(dates.alias("Screening_Date"), F.col("o_orderstatus").alias("Case_Status"), F.col("o_totalprice").alias("seen.by"))
    undated = named.limit(5).withColumn("Screening_Date", F.lit("not known"))
    stores.write_csv(named.unionByName(undated), path)
    return series.case_series(readers.read_line_list(spark, path, "all", strict=False), word="f")


@query(f"WITH {ORDERS} SELECT 'one' AS series_id, ds, CAST(sum(y) AS DOUBLE) AS y FROM series GROUP BY ds")
def series_from_csv(spark, folder):
    """A monthly series kept as a CSV file with rows that lack a date or a count."""
    path = scratch_path(spark, "series")
    sums = orders_monthly(spark, folder).groupBy("ds").agg(F.sum("y").alias("y"))
    rows = sums.select(F.col("ds").cast("string").alias("ds"), F.col("y").cast("string").alias("y"), F.lit("x").alias("note"))
    broken = rows.limit(4).select(F.when(F.col("y") > "2", F.col("ds")).alias("ds"), F.when(F.col("y") <= "2", "many").alias("y"), "note")
    stores.write_csv(rows.unionByName(broken), path)
    return readers.read_series(spark, path, "one")


@query("SELECT o_orderkey AS record_id, o_orderstatus AS status FROM orders")
def renamed_columns(spark, folder):
    """Columns whose names have dots, selected under new names; all others dropped."""
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("record.id"), F.col("o_orderstatus").alias("case status"), "o_totalprice")
    kept = readers.dropped(rows, ["o_totalprice"])
    return readers.renamed(kept, {"record.id": "record_id", "case status": "status"})
