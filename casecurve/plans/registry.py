"""The catalogue of named queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name, with its SQL equivalent where one exists."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


# -- shared SQL pieces --------------------------------------------------------------------------


def series_ctes(source: str, key: str, ts: str, where: str = "true", period: str = "month", prefix: str = "") -> str:
    """CTEs ending in ``{prefix}series(series_id, ds, y)``: gap-free counts per period."""
    p = prefix
    step = "INTERVAL 1 MONTH" if period == "month" else "INTERVAL 1 DAY"
    return f"""
    {p}counts AS (
      SELECT {key} AS series_id, CAST(date_trunc('{period}', {ts}) AS DATE) AS ds, count(*) AS y
      FROM {source} WHERE {ts} IS NOT NULL AND ({where}) GROUP BY 1, 2),
    {p}span AS (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM {p}counts GROUP BY 1),
    {p}spine AS (
      SELECT series_id,
             CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), {step})) AS DATE) AS ds
      FROM {p}span),
    {p}series AS (
      SELECT s.series_id, s.ds, CAST(coalesce(c.y, 0) AS BIGINT) AS y
      FROM {p}spine s LEFT JOIN {p}counts c ON c.series_id = s.series_id AND c.ds = s.ds)"""


ORDERS = series_ctes("orders", "o_orderpriority", "o_orderdate", "lower(o_orderstatus) = 'f'")
LINEITEM = series_ctes("lineitem", "l_returnflag", "l_shipdate", "lower(l_linestatus) = 'f'", prefix="li_")

GLOBAL = """
    overall AS (
      SELECT series_id, round_even(avg(y), 1) AS mean, round_even(stddev_samp(y), 1) AS std,
             count(y) AS total_periods, max(ds) AS last_ds, CAST(max_by(y, ds) AS BIGINT) AS last_cases
      FROM series GROUP BY 1)"""


def seasonal_cte(fallback: str = "service") -> str:
    if fallback == "trainer":
        seen, unseen = "CASE WHEN n > 1 THEN sd ELSE mu * 0.2::double END", "gsd"
    else:
        seen = "CASE WHEN n > 1 AND sd > 1e-6::double THEN sd ELSE greatest(mu * 0.25::double, 1.0::double) END"
        unseen = "CASE WHEN gsd > 1e-6::double THEN gsd ELSE greatest(gmu * 0.25::double, 1.0::double) END"
    return f"""
    by_month AS (
      SELECT series_id, month(ds) AS month, count(*) AS n, avg(y) AS mu, stddev_samp(y) AS sd
      FROM series GROUP BY 1, 2),
    levels AS (SELECT series_id, avg(y) AS gmu, stddev_samp(y) AS gsd FROM series GROUP BY 1),
    year_months AS (SELECT series_id, gmu, gsd, unnest(range(1, 13)) AS month FROM levels),
    seasonal AS (
      SELECT g.series_id, CAST(g.month AS INTEGER) AS month, coalesce(m.n, 0) AS n,
             round_even(CASE WHEN m.n > 0 THEN mu ELSE gmu END, 1) AS mean,
             round_even(CASE WHEN m.n > 0 THEN {seen} ELSE {unseen} END, 1) AS std
      FROM year_months g LEFT JOIN by_month m ON m.series_id = g.series_id AND m.month = g.month)"""


GRADE = "CASE WHEN {z} IS NULL OR isnan({z}) THEN NULL WHEN {z} < 2 THEN 'Normal' WHEN {z} < 3 THEN 'Alert' ELSE 'Critical' END"


def scan_cte(series: str = "series", name: str = "scan") -> str:
    return f"""
    {name}_z AS (
      SELECT series_id, ds, y, round_even(mu, 1) AS baseline_mean, round_even(sd, 1) AS baseline_std,
             round_even((y - mu) / sd, 2) AS z_score
      FROM (SELECT series_id, ds, y, avg(y) OVER w AS mu,
                   CASE WHEN stddev_samp(y) OVER w > 1e-6::double THEN stddev_samp(y) OVER w ELSE 1.0::double END AS sd
            FROM {series} WINDOW w AS (PARTITION BY series_id))),
    {name} AS (
      SELECT *, {GRADE.format(z='z_score')} AS risk_level,
             coalesce(({GRADE.format(z='z_score')}) IN ('Alert', 'Critical'), false) AS is_anomaly
      FROM {name}_z)"""
