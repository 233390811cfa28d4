"""Patient screening: classification of intakes with the community's current risk beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.functions.text import percent_text, screening_message
from casecurve.operators.classify import Classifier, scored
from casecurve.operators.intake import screening_features
from casecurve.session import saved_table
from casecurve.sources import stores


def predicted_intakes(intakes: DataFrame, classifier: Classifier) -> DataFrame:
    """Adds predicted disease, probabilities and the probability of the chosen class."""
    out = scored(screening_features(intakes), classifier)
    return out.withColumn("confidence", F.bround(F.col("probabilities")[F.col("prediction")], 4)).withColumnRenamed(
        "prediction", "predicted_disease"
    )


def with_context(predicted: DataFrame, status: DataFrame) -> DataFrame:
    """Adds the latest grade of the predicted disease's own series and the result sentence.

    ``status`` has one row per series; it is saved by the caller, so its size decides the join.
    """
    context = status.select(
        F.col("series_id").alias("predicted_disease"),
        F.col("cases").alias("latest_observed_cases"),
        F.col("baseline_mean").alias("historical_mean"),
        F.col("z_score").alias("current_z_score"),
        F.col("risk_level").alias("current_outbreak_risk"),
        F.col("is_anomaly").alias("is_outbreak_active"),
    )
    joined = predicted.join(context, "predicted_disease", "left")
    return joined.withColumns(
        {
            "confidence_percentage": percent_text(F.col("confidence")),
            "details": screening_message(
                F.col("predicted_disease"), F.col("confidence"), F.col("current_outbreak_risk"), F.col("current_z_score")
            ),
        }
    )


def screen(intakes: DataFrame, classifier: Classifier, status: DataFrame) -> DataFrame:
    """Screens a table of intakes; the intakes are not shuffled while ``status`` is small."""
    return with_context(predicted_intakes(intakes, classifier), saved_table(status, "status"))


def store_screened(screened: DataFrame, path: str) -> None:
    """Appends screened intakes, each with its disease, confidence and, where given, centre and confirmed disease."""
    stores.append(stores.intake_records(screened), path, stores.INTAKES_SCHEMA)
