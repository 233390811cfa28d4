"""Continuous screening: each arriving intake is classified and stored with its context."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casecurve.operators.classify import Classifier
from casecurve.operators.intake import valid_intakes
from casecurve.plans.screening import predicted_intakes, with_context
from casecurve.sources import stores

STORED = [
    "patient_code", "age", "gender", "fever_duration_days", "skin_manifestation", "predicted_disease", "confidence",
    "latest_observed_cases", "current_z_score", "current_outbreak_risk", "is_outbreak_active", "details",
]


def screened_stream(intakes: DataFrame, classifier: Classifier, status: DataFrame, request_id: str | None = None) -> DataFrame:
    """Valid intakes with prediction and context.

    Every consultation counts, so patient codes may repeat; only a repeated ``request_id`` is dropped,
    within the watermark the caller set on the stream.
    """
    rows = intakes.dropDuplicatesWithinWatermark([request_id]) if request_id else intakes
    out = with_context(predicted_intakes(valid_intakes(rows), classifier), status)
    return out.select(*STORED).withColumn("confidence", F.bround("confidence", 4))


def start_screening(
    intakes: DataFrame, classifier: Classifier, status: DataFrame, out: str, checkpoint: str,
    request_id: str | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Appends screened intakes to parquet; a stream-static join, no state without ``request_id``."""
    writer = (
        screened_stream(intakes, classifier, status, request_id)
        .writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_storing(screened: DataFrame, out: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Appends screened intakes to the stored intake table, in its own columns."""
    records = stores.shaped(stores.intake_records(screened), stores.INTAKES_SCHEMA)
    writer = records.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
