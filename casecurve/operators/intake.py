"""Clinical record sources brought to one shape, and checks of screening intakes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casecurve.functions.numbers import lenient_double, per_thousand_to_count, positive_flag
from casecurve.functions.text import repaired_gender, skin_flag, title_case, yes_no_flag
from casecurve.operators.impute import fill_median

# Label names, and the statuses that count as a confirmed case of the second source.
DENGUE, TYPHOID = "Dengue", "Typhoid"
CONFIRMED_TYPHOID = ["Acute Typhoid Fever", "Relapsing Typhoid", "Complicated Typhoid"]
NUMERIC = ["age", "fever_duration", "skin_manifestation", "platelet_count", "wbc"]
# The four intake features, and the two laboratory ones.
INTAKE_FEATURES = ["age", "gender", "fever_duration", "skin_manifestation"]
LAB_FEATURES = ["platelet_count", "wbc"]


def dengue_records(raw: DataFrame, scale_labs: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """First source: text columns Age, Gender, Fever, Fever_Duration, Rash, PLT, WBC.

    Its laboratory values are in thousands; ``scale_labs=False`` leaves them so.
    """
    lab = per_thousand_to_count if scale_labs else lenient_double
    return raw.select(
        *extra,
        lenient_double(F.col("Age")).alias("age"),
        title_case(F.col("Gender")).alias("gender"),
        lenient_double(F.col("Fever")).alias("fever"),
        lenient_double(F.col("Fever_Duration")).alias("fever_duration"),
        yes_no_flag(F.col("Rash")).cast("double").alias("skin_manifestation"),
        lab(F.col("PLT")).alias("platelet_count"),
        lab(F.col("WBC")).alias("wbc"),
        F.lit(DENGUE).alias("disease"),
    )


def typhoid_records(raw: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Second source, confirmed statuses only; the fever flag follows from the duration."""
    duration = lenient_double(F.col("Fever Duration (Days)"))
    return raw.where(F.col("Typhoid Status").isin(CONFIRMED_TYPHOID)).select(
        *extra,
        lenient_double(F.col("Age")).alias("age"),
        title_case(F.col("Gender")).alias("gender"),
        duration.alias("fever_duration"),
        positive_flag(duration).cast("double").alias("fever"),
        yes_no_flag(F.col("Skin Manifestations")).cast("double").alias("skin_manifestation"),
        lenient_double(F.col("Platelet Count")).alias("platelet_count"),
        lenient_double(F.col("White Blood Cell Count")).alias("wbc"),
        F.lit(TYPHOID).alias("disease"),
    )


def unified_records(dengue: DataFrame, typhoid: DataFrame, impute: bool = True) -> DataFrame:
    """Both sources by column name; missing numbers take the median of the whole set."""
    rows = dengue.unionByName(typhoid)
    return fill_median(rows, NUMERIC) if impute else rows


def feature_columns(include_labs: bool = False) -> list[str]:
    return INTAKE_FEATURES + (LAB_FEATURES if include_labs else [])


# Accepted ranges and genders of an intake.
AGE_RANGE, FEVER_RANGE, INTAKE_GENDERS = (0, 120), (1, 120), ["Male", "Female", "Other"]


def rejection_reason() -> Column:
    """Why an intake is not acceptable, null if it is."""
    outside = lambda c, r: F.col(c).isNull() | ~F.col(c).between(*r)
    return (
        F.when(F.length(F.coalesce("patient_code", F.lit(""))) == 0, "patient_code missing")
        .when(outside("age", AGE_RANGE), "age out of range")
        .when(F.col("gender").isNull() | ~F.col("gender").isin(INTAKE_GENDERS), "gender unknown")
        .when(outside("fever_duration_days", FEVER_RANGE), "fever duration out of range")
        .when(F.col("skin_manifestation").isNull(), "skin manifestation missing")
    )


def checked_intakes(intakes: DataFrame) -> DataFrame:
    """Adds ``reason``; rows with a null reason are valid."""
    return intakes.withColumn("reason", rejection_reason())


def valid_intakes(intakes: DataFrame) -> DataFrame:
    return checked_intakes(intakes).where("reason is null").drop("reason")


def screening_features(intakes: DataFrame) -> DataFrame:
    """Adds the model's feature columns to intakes; gender and skin answers are repaired."""
    skin_kind = {"boolean": "boolean", "string": "text"}.get(dict(intakes.dtypes)["skin_manifestation"], "number")
    return (
        intakes.withColumn("_skin", skin_flag(F.col("skin_manifestation"), skin_kind).cast("double"))
        .withColumn("age", F.col("age").cast("double"))
        .withColumn("gender", repaired_gender(F.col("gender")))
        .withColumn("fever_duration", F.col("fever_duration_days").cast("double"))
        .withColumn("skin_manifestation", F.col("_skin"))
        .drop("_skin")
    )
