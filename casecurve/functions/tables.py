"""Forecasts as a table function for plain SQL.

``series_forecast(TABLE(t) PARTITION BY key ORDER BY ds, model => ..., steps => ...)`` reads one series per
partition and gives its future periods. Spark brings a series' rows together and in order; the function holds
one short list of values. The result's columns follow from the table's, so any number of keys will do.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import DateType, DoubleType, IntegerType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from casecurve.operators import forecast

TABLE_MODELS = ("flat", "linear", "seasonal_mean", "holt_winters")


def next_start(ds: dt.date, period: str, n: int) -> dt.date:
    """The first day of the n-th period after that of ``ds``."""
    if period == "month":
        months = ds.year * 12 + ds.month - 1 + n
        return dt.date(months // 12, months % 12 + 1, 1)
    return ds + dt.timedelta(days=n if period == "day" else 7 * n)


def index_of(ds: dt.date, period: str) -> int:
    """A whole number that grows by one from each period to the next."""
    if period == "month":
        return ds.year * 12 + ds.month
    days = (ds - dt.date(1970, 1, 5)).days
    return days if period == "day" else days // 7


def smoothed(y: np.ndarray, season: int, alpha: float | None, gamma: float | None) -> tuple[float, np.ndarray]:
    """Level and season ring after the last value; weights that are not given are fitted with the start."""
    row, n = y[None, :], np.array([len(y)])
    if alpha is None or gamma is None:
        weights = forecast._best_weights(row, n, season)
        weights, begin = forecast._joint(row, n, weights, forecast._best_start(row, n, weights, season), season)
        (alpha, gamma), level, ring = weights[0], begin[0, 0], begin[0, 1:].copy()
    else:
        level = y[:season].mean()
        ring = np.zeros(season)
        ring[: min(season, len(y))] = y[:season] - level
    for t, value in enumerate(y):
        error = value - level - ring[t % season]
        level += alpha * error
        ring[t % season] += gamma * error
    return float(level), ring


def ahead(days: list[dt.date], y: np.ndarray, model: str, steps: int, period: str, season: int, alpha, gamma) -> list[float]:
    """The next ``steps`` values of one series."""
    if model == "flat":
        return [float(y.mean())] * steps
    if model == "linear":
        t = np.array([index_of(d, period) for d in days], dtype=float)
        centred = t - t.mean()
        slope = float(centred @ (y - y.mean()) / (centred @ centred)) if centred.any() else 0.0
        return [float(y.mean() + slope * (t[-1] + h - t.mean())) for h in range(1, steps + 1)]
    if model == "seasonal_mean":
        months = np.array([d.month for d in days])
        future = [next_start(days[-1], period, h).month for h in range(1, steps + 1)]
        return [float(y[months == m].mean() if (months == m).any() else y.mean()) for m in future]
    level, ring = smoothed(y, season, alpha, gamma)
    return [level + float(ring[(len(y) + h) % season]) for h in range(steps)]


class SeriesForecast:
    """Columns of the table: ``ds``, ``y`` and any others, which are keys. Rows without date or value are passed over."""

    @staticmethod
    def analyze(
        rows: AnalyzeArgument,
        model: AnalyzeArgument | None = None,
        steps: AnalyzeArgument | None = None,
        period: AnalyzeArgument | None = None,
        season: AnalyzeArgument | None = None,
        alpha: AnalyzeArgument | None = None,
        gamma: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        if not rows.isTable:
            raise ValueError("the first argument is a table: TABLE(t) PARTITION BY its keys")
        names = [f.name for f in rows.dataType.fields]
        if "ds" not in names or "y" not in names:
            raise ValueError(f"the table needs ds and y, it has {', '.join(names)}")
        for argument, known in ((model, TABLE_MODELS), (period, ("month", "week", "day"))):
            if argument is not None and argument.value not in known:
                raise ValueError(f"{argument.value} is none of {', '.join(known)}")
        schema = StructType([f for f in rows.dataType.fields if f.name not in ("ds", "y")])
        return AnalyzeResult(schema.add("ds", DateType()).add("step", IntegerType()).add("yhat", DoubleType()))

    def __init__(self) -> None:
        self.key: tuple | None = None
        self.days: list[dt.date] = []
        self.values: list[float] = []
        self.settings: dict = {}

    def eval(self, rows: Row, model="linear", steps=6, period="month", season=None, alpha=None, gamma=None):
        known = rows.asDict()
        ds, y = known.pop("ds"), known.pop("y")
        self.key = tuple(known.values())
        self.settings = {"model": model, "steps": steps, "period": period, "alpha": alpha, "gamma": gamma}
        self.settings["season"] = season or {"month": 12, "week": 52, "day": 7}[period]
        if ds is not None and y is not None:
            self.days.append(ds.date() if isinstance(ds, dt.datetime) else ds)
            self.values.append(float(y))
        return
        yield

    def terminate(self):
        if self.values:
            # In time order even if the caller gave no ORDER BY.
            order = sorted(range(len(self.days)), key=self.days.__getitem__)
            days, y = [self.days[i] for i in order], np.array([self.values[i] for i in order])
            for h, value in enumerate(ahead(days, y, **self.settings), start=1):
                yield (*self.key, next_start(days[-1], self.settings["period"], h), h, value)


def register_table_functions(spark: SparkSession) -> None:
    """Makes ``series_forecast`` known to ``spark.sql``."""
    spark.udtf.register("series_forecast", udtf(SeriesForecast))
