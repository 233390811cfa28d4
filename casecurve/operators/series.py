"""Count series: from a case line list to gap-free periods per series.

The only pass over the line list is one partially aggregated count; everything after works on one
row per series and period, so a series holding most of the cases costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casecurve.functions.dates import next_period, period_start, step_interval
from casecurve.functions.text import is_word
from casecurve.session import saved_table

KEYS = ("series_id",)


def confirmed_cases(cases: DataFrame, status: str = "status", word: str = "confirmed") -> DataFrame:
    """Rows whose status is ``word`` in any casing."""
    return cases.where(is_word(F.col(status), word))


def count_cases(
    cases: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = "event_ts",
    period: str = "month",
    complete_until: str | None = None,
) -> DataFrame:
    """Cases per series and period as ``keys, ds, y``; undated rows are left out.

    ``complete_until`` (a date) drops the period that contains it, and later ones, as partial.
    """
    ds = period_start(F.col(ts), period)
    rows = cases.where(F.col(ts).isNotNull())
    if complete_until:
        rows = rows.where(F.col(ts) < period_start(F.lit(complete_until).cast("date"), period))
    return rows.groupBy(*keys, ds.alias("ds")).agg(F.count(F.lit(1)).alias("y"))


def fill_gaps(series: DataFrame, keys: Sequence[str] = KEYS, period: str = "month", fill: int = 0) -> DataFrame:
    """Every period from a series' first to its last; absent ones get ``fill``.

    Each row is repeated up to the row that follows it, so no calendar table and no join is needed.
    """
    following = F.lead("ds").over(Window.partitionBy(*keys).orderBy("ds"))
    last_before = F.coalesce(next_period(F.col("_next"), period, -1), F.col("ds"))
    return (
        series.withColumn("_next", following)
        .select(*keys, "y", F.posexplode(F.sequence(F.col("ds"), last_before, step_interval(period))).alias("_pos", "ds"))
        .select(*keys, "ds", F.when(F.col("_pos") == 0, F.col("y")).otherwise(F.lit(fill)).alias("y"))
    )


def case_series(
    cases: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = "event_ts",
    period: str = "month",
    status: str | None = "status",
    word: str = "confirmed",
    complete_until: str | None = None,
) -> DataFrame:
    """Gap-free count series of the confirmed cases."""
    rows = confirmed_cases(cases, status, word) if status else cases
    return fill_gaps(count_cases(rows, keys, ts, period, complete_until), keys, period)


def series_span(series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return series.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_periods"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds")
    )


def future_periods(last: DataFrame, steps: int, keys: Sequence[str] = KEYS, period: str = "month") -> DataFrame:
    """The ``steps`` periods after each series' ``last_ds``, as ``ds`` and ``step`` 1..steps.

    Other columns of ``last`` are carried along.
    """
    start = next_period(period_start(F.col("last_ds"), period), period, 1)
    end = next_period(period_start(F.col("last_ds"), period), period, steps)
    return last.select("*", F.posexplode(F.sequence(start, end, step_interval(period))).alias("_pos", "ds")).select(
        "*", (F.col("_pos") + 1).alias("step")
    ).drop("_pos")


def _position(keys: Sequence[str], newest_first: bool = False) -> Column:
    order = F.col("ds").desc() if newest_first else F.col("ds")
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order))


def _length(keys: Sequence[str]) -> Column:
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


def last_rows(series: DataFrame, n: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """The newest ``n`` periods of every series."""
    return series.withColumn("_pos", _position(keys, newest_first=True)).where(F.col("_pos") <= n).drop("_pos")


def holdout_split(series: DataFrame, horizon: int = 6, min_train: int = 0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``part``: ``test`` for the last ``horizon`` periods, else ``train``.

    A series with ``horizon + min_train`` periods or fewer is not split: all of it is ``train``.
    """
    return (
        series.withColumn("_pos", _position(keys, newest_first=True))
        .withColumn("_n", _length(keys))
        .withColumn("part", F.when((F.col("_pos") <= horizon) & (F.col("_n") > horizon + min_train), "test").otherwise("train"))
        .drop("_pos", "_n")
    )


def prefix_split(series: DataFrame, percent: int = 80, keys: Sequence[str] = KEYS) -> DataFrame:
    """Adds ``part``: ``train`` for the first ``percent`` of the periods (rounded down)."""
    cut = F.floor(_length(keys) * percent / 100)
    return (
        series.withColumn("_pos", _position(keys))
        .withColumn("part", F.when(F.col("_pos") <= cut, "train").otherwise("test"))
        .drop("_pos")
    )


# Training lengths of the rolling-origin evaluation.
ORIGINS = (40, 46, 52)


def rolling_folds(
    series: DataFrame, origins: Sequence[int] = ORIGINS, horizon: int = 6, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One copy of a series' rows per origin that has something to test: train prefix, next periods.

    Adds ``origin`` and ``part``; (keys, origin) identifies a fold, so all folds run in one job.
    """
    origin, pos = F.col("origin"), F.col("_pos")
    return (
        series.withColumn("_pos", _position(keys))
        .withColumn("_n", _length(keys))
        .withColumn("origin", F.explode(F.array(*[F.lit(int(o)) for o in origins])))
        .where((pos <= origin + horizon) & (F.col("_n") > origin))
        .withColumn("part", F.when(pos <= origin, "train").otherwise("test"))
        .drop("_pos", "_n")
    )


def wide(rows: DataFrame, value: str, names: Sequence[str] | None = None, key: str = "series_id") -> DataFrame:
    """One row per period with a column per series holding ``value``; null where a series has none.

    Without ``names`` all series found get a column, in name order: a table for people, so the series
    should be few.
    """
    if names is None:
        rows = saved_table(rows.select("ds", key, value), "wide")
        names = [r[0] for r in rows.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).collect()]
    return rows.groupBy("ds").pivot(key, list(names)).agg(F.max(value))
