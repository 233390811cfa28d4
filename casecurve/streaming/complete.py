"""Continuous counting that also reports windows without events, graded against a baseline kept in state.

Events are first counted per series and window in the JVM, with partial sums before the shuffle. The closed
windows, one row each, then pass a stateful operator per series. It knows the next window it waits for and the
running mean and squared deviations of all windows before it. A window that brings no row is emitted as 0 as
soon as a later one comes or, by an event-time timer, when the watermark has passed its end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from casecurve.functions.risk import is_anomalous, risk_grade, z_score
from casecurve.operators.series import KEYS
from casecurve.streaming.alerts import windowed_counts

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class CompleteWindows(StatefulProcessor):
    """Per series: every window from its first on, in order, with the moments of the windows before it."""

    def __init__(self, keys: Sequence[str], width_ms: int):
        self.keys, self.width = list(keys), width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Start of the window waited for (ms), windows so far, their mean and sum of squared deviations.
        self.seen = handle.getValueState("seen", "upcoming long, n long, mean double, squares double")

    def _emit(self, key, state: list, counts: dict[int, int], until: int) -> pd.DataFrame:
        """All windows from the one waited for to those that end by ``until``; moves ``state`` on."""
        rows = []
        while state[0] + self.width <= until:
            upcoming, n, mean, squares = state
            y = counts.get(upcoming, 0)
            std = (squares / (n - 1)) ** 0.5 if n > 1 else None
            rows.append((*key, pd.Timestamp(upcoming, unit="ms", tz="UTC"), y, n, mean if n else None, std))
            gap = y - mean
            mean += gap / (n + 1)
            state[:] = [upcoming + self.width, n + 1, mean, squares + gap * (y - mean)]
        return pd.DataFrame(rows, columns=[*self.keys, "window_start", "y", "n_before", "mean", "std"])

    def _go_on(self, key, counts: dict[int, int], watermark: int) -> Iterator[pd.DataFrame]:
        if self.seen.exists():
            state = list(self.seen.get())
        else:
            state = [min(counts), 0, 0.0, 0.0]
        until = max([watermark, *(start + self.width for start in counts)])
        rows = self._emit(key, state, counts, until)
        if len(rows):
            self.seen.update(tuple(state))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(state[0] + self.width)
            yield rows

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for batch in rows:
            starts = batch["window_ms"].astype("int64").tolist()
            for start, y in zip(starts, batch["y"].tolist()):
                counts[start] = counts.get(start, 0) + y
        yield from self._go_on(key, counts, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._go_on(key, {}, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def complete_windows(
    events: DataFrame, keys: Sequence[str] = KEYS, ts: str = "event_ts", days: int = 1, lateness: str = "1 day"
) -> DataFrame:
    """``keys, window_start, y, n_before, mean, std, z_score, risk_level, is_anomaly``: each closed window once, empty ones as 0.

    Windows of ``days`` whole days run from a series' first event on without gaps. ``mean`` and ``std`` (sample) are
    those of the series' windows before; with fewer than two there is no grade. A series is known from
    its first closed window on. A key that is null is a series of its own.
    """
    counted = windowed_counts(events, keys, ts, f"{days} days", lateness)
    # The window's end is the event time of the second operator.
    rows = counted.select(*keys, "window_end", F.unix_millis("window_start").alias("window_ms"), "y")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", window_start timestamp, y long, n_before long, mean double, std double"
    emitted = rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=CompleteWindows(keys, days * 86_400_000), outputStructType=schema, outputMode="append", timeMode="EventTime"
    )
    enough = F.col("n_before") > 1
    z = F.when(enough, F.bround(z_score(F.col("y"), F.col("mean"), F.col("std")), 2))
    graded = emitted.withColumn("z_score", z).withColumn("risk_level", risk_grade(F.col("z_score")))
    return graded.withColumn("is_anomaly", is_anomalous(F.col("risk_level")))


def start_complete_windows(
    events: DataFrame, out: str, checkpoint: str, keys: Sequence[str] = KEYS, days: int = 1, lateness: str = "1 day",
    available_now: bool = False,
) -> StreamingQuery:
    """Appends every closed window to ``out``. The state lives in RocksDB, which the stateful operator needs."""
    spark = events.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        frame = complete_windows(events, keys, days=days, lateness=lateness)
        writer = frame.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer).start()
    finally:
        # The query has its own copy of the settings.
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
