"""Continuous counting and alerting over an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casecurve.functions.risk import is_anomalous, risk_grade, z_score
from casecurve.functions.text import alert_message
from casecurve.operators.series import KEYS


def windowed_counts(
    events: DataFrame, keys: Sequence[str] = KEYS, ts: str = "event_ts", window: str = "1 day", lateness: str = "1 day"
) -> DataFrame:
    """Events per series and tumbling window; rows later than ``lateness`` are dropped.

    Works on streams and on static tables. Counts are combined before the shuffle, so a busy series
    costs its state one row per window and task.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    counted = timed.groupBy(F.window(ts, window), *keys).agg(F.count(F.lit(1)).alias("y"))
    return counted.select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "y")


def graded_windows(counts: DataFrame, baseline: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Window counts against a static baseline (``mean``, ``std`` per series)."""
    joined = counts.join(baseline.select(*keys, "mean", "std"), list(keys), "left")
    z = F.bround(z_score(F.col("y"), F.col("mean"), F.col("std")), 2)
    return joined.withColumn("z_score", z).withColumn("risk_level", risk_grade(F.col("z_score"))).withColumn(
        "is_anomaly", is_anomalous(F.col("risk_level"))
    ).drop("mean", "std")


def start_alerting(
    events: DataFrame, baseline: DataFrame, out: str, checkpoint: str, keys: Sequence[str] = KEYS,
    window: str = "1 day", lateness: str = "1 day", available_now: bool = False,
) -> StreamingQuery:
    """Writes every changed window with its grade; ``current_windows`` reads the newest state.

    A batch overwrites only its own folder, so a batch repeated after a failure changes nothing.
    """
    counts = windowed_counts(events, keys, window=window, lateness=lateness)

    def store(batch: DataFrame, batch_id: int) -> None:
        graded_windows(batch, baseline, keys).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_windows(spark: SparkSession, out: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The latest grade of every window seen so far."""
    rows = spark.read.option("basePath", out).parquet(out)
    others = [c for c in rows.columns if c not in (*keys, "window_start", "batch_id")]
    newest = F.max_by(F.struct(*others), "batch_id").alias("_row")
    return rows.groupBy(*keys, "window_start").agg(newest).select(*keys, "window_start", "_row.*")


def start_closed_windows(
    events: DataFrame, out: str, checkpoint: str, keys: Sequence[str] = KEYS, window: str = "1 day",
    lateness: str = "1 day", available_now: bool = False,
) -> StreamingQuery:
    """Appends each window once, when the watermark has passed its end."""
    writer = (
        windowed_counts(events, keys, window=window, lateness=lateness)
        .writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def window_alerts(windows: DataFrame, region: str, series: str = "series_id", style: str = "summary") -> DataFrame:
    """Alert records of the anomalous windows, one per series and window: writing them again changes nothing
    for a store that is keyed by ``disease`` and ``window_start``."""
    return windows.where("is_anomaly").select(
        F.col(series).alias("disease"),
        "window_start",
        F.lit(region).alias("region"),
        "risk_level",
        F.bround("z_score", 3).alias("z_score"),
        alert_message(F.col(series), F.col("window_start"), F.col("y"), F.col("z_score"), style).alias("alert_message"),
        F.lit(False).alias("is_resolved"),
    )


def compact_windows(spark: SparkSession, out: str, target: str, keys: Sequence[str] = KEYS) -> None:
    """Writes the newest state of every window as one table, so that readers need not visit every batch."""
    current_windows(spark, out, keys).write.mode("overwrite").parquet(target)
