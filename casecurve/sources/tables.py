"""The driver's parquet tables in the roles the operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a case line list: one series per priority, status F is a confirmed case."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("record_id"),
        F.col("o_orderpriority").alias("series_id"),
        F.col("o_orderdate").alias("event_ts"),
        F.col("o_orderstatus").alias("status"),
    )


def lineitem_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a larger line list: one series per return flag."""
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("series_id"),
        F.col("l_shipdate").alias("event_ts"),
        F.col("l_linestatus").alias("status"),
    )


def event_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a stream of cases: one series per event type, all confirmed."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("record_id"), F.col("event_type").alias("series_id"), F.col("ts").alias("event_ts")
    )


def clinical(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as two-class clinical rows: two numbers, two categories, one label."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, folder, "labels")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        "lang",
        "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("double").alias("toxic"),
        F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"),
    )


# -- derived clinical inputs: real rows, with columns in the shape of the two clinical sources -----


def nth_text(key: str, texts: list[str | None]):
    """The (key mod n)-th of the texts."""
    choice = F.when(F.col(key) % len(texts) == 0, F.lit(texts[0]))
    for i, text in enumerate(texts[1:], start=1):
        choice = choice.when(F.col(key) % len(texts) == i, F.lit(text))
    return choice


GENDER_TEXTS = [" male ", "FEMALE", "Male", "female"]
STATUS_BY_SEGMENT = {
    "AUTOMOBILE": "Acute Typhoid Fever",
    "BUILDING": "Relapsing Typhoid",
    "FURNITURE": "Complicated Typhoid",
    "HOUSEHOLD": "Acute Typhoid Fever",
    "MACHINERY": "Suspected",
}


def supplier_records(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as raw rows of the first clinical source."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("A-"), key.cast("string")).alias("record_id"),
        F.when(key % 17 == 0, "unknown").otherwise((key % 60).cast("string")).alias("Age"),
        nth_text("s_suppkey", GENDER_TEXTS).alias("Gender"),
        F.lit("1").alias("Fever"),
        (1 + F.col("s_nationkey") % 7).cast("string").alias("Fever_Duration"),
        nth_text("s_suppkey", ["no", "Yes", " YES", "n/a"]).alias("Rash"),
        (60 + key % 90).cast("string").alias("PLT"),
        (2 + key % 5).cast("string").alias("WBC"),
    )


def customer_records(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as raw rows of the second clinical source."""
    key = F.col("c_custkey")
    status = F.lit(None).cast("string")
    for segment, text in STATUS_BY_SEGMENT.items():
        status = F.when(F.col("c_mktsegment") == segment, text).otherwise(status)
    return table(spark, folder, "customer").select(
        F.concat(F.lit("B-"), key.cast("string")).alias("record_id"),
        F.when(key % 17 == 0, "unknown").otherwise((key % 85).cast("string")).alias("Age"),
        nth_text("c_custkey", GENDER_TEXTS).alias("Gender"),
        F.when(key % 11 == 0, "").otherwise((5 + F.col("c_nationkey") % 14).cast("string")).alias("Fever Duration (Days)"),
        nth_text("c_custkey", ["Yes", "No", "no ", "NO", "?"]).alias("Skin Manifestations"),
        (100000 + key % 900 * 100).cast("string").alias("Platelet Count"),
        (3000 + key % 70 * 100).cast("string").alias("White Blood Cell Count"),
        status.alias("Typhoid Status"),
    )


def intakes_of(events: DataFrame) -> DataFrame:
    """Events (a table or a stream) as screening intakes, some of them out of range."""
    event = F.col("event_id")
    return events.select(
        "event_id",
        F.concat(F.lit("P-"), F.col("user_id").cast("string")).alias("patient_code"),
        (F.get_json_object("props", "$.k").cast("int") + event % 40).cast("int").alias("age"),
        nth_text("event_id", ["Male", "Female", "Other", "Male", "unstated"]).alias("gender"),
        F.floor(F.col("value") / 3).cast("int").alias("fever_duration_days"),
        F.when((F.col("event_type") == "error") & (event % 10 == 0), F.lit(None).cast("boolean"))
        .otherwise(F.col("event_type").isin("click", "view"))
        .alias("skin_manifestation"),
        F.col("ts").alias("created_at"),
    )


def event_intakes(spark: SparkSession, folder: str) -> DataFrame:
    return intakes_of(table(spark, folder, "events"))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table read as a file stream."""
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)


def disease_cases(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as case lists of two diseases, by return flag."""
    disease = F.when(F.col("series_id") == "R", "Dengue").when(F.col("series_id") == "A", "Typhoid")
    return lineitem_cases(spark, folder).withColumn("series_id", disease).where("series_id is not null")
