"""The region registry, derived from case counts per nation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casecurve.functions.text import is_word
from casecurve.operators.risk import scan_history
from casecurve.operators.series import fill_gaps
from casecurve.session import saved_table
from casecurve.sources.tables import table

DENGUE_PRIORITIES = ["1-URGENT", "2-HIGH"]
TYPHOID_PRIORITIES = ["3-MEDIUM", "4-NOT SPECIFIED"]


def _cases_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """``id, ds, priority, y``: counted per customer first, so one busy customer joins as few rows."""
    orders = table(spark, folder, "orders").where(is_word(F.col("o_orderstatus"), "f"))
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("ds")
    per_customer = orders.groupBy("o_custkey", month, F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("y"))
    nation = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("id"))
    return per_customer.join(nation, "o_custkey").groupBy("id", "ds", "priority").agg(F.sum("y").alias("y"))


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """One row per nation with cases: latest month graded, main disease, hospitals, place.

    Saved, as filters, searches and roll-ups read it again and again.
    """
    cases = saved_table(_cases_by_nation(spark, folder), "cases")
    monthly = fill_gaps(cases.groupBy("id", "ds").agg(F.sum("y").alias("y")), ["id"])
    graded = scan_history(monthly, ["id"]).withColumn("_before", F.lag("y").over(Window.partitionBy("id").orderBy("ds")))
    latest = F.max_by(F.struct("y", "_before", "z_score", "risk_level"), "ds").alias("l")
    change = (F.col("l.y") - F.col("l._before")) * 100.0 / F.greatest(F.col("l._before"), F.lit(1))
    status = graded.groupBy("id").agg(latest).select(
        "id",
        F.col("l.risk_level").alias("risk_level"),
        F.col("l.z_score").alias("z_score"),
        F.col("l.y").alias("projected_cases"),
        F.bround(change, 1).alias("case_change_pct"),
    )
    disease = cases.groupBy("id").agg(
        F.sum(F.when(F.col("priority").isin(DENGUE_PRIORITIES), F.col("y")).otherwise(0)).alias("d"),
        F.sum(F.when(F.col("priority").isin(TYPHOID_PRIORITIES), F.col("y")).otherwise(0)).alias("t"),
    ).select("id", F.when(F.col("d") >= F.col("t"), "Dengue").otherwise("Typhoid").alias("primary_disease"))

    customers = table(spark, folder, "customer")
    segments = customers.groupBy(F.col("c_nationkey").alias("id"), "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_acctbal").alias("balance")
    )
    people = segments.groupBy("id").agg(
        F.min_by("c_mktsegment", F.struct(-F.col("n"), "c_mktsegment")).alias("dominant_vector"),
        (F.sum("balance") / 1e6).alias("population_at_risk_millions"),
    )
    place = Window.partitionBy("s_nationkey").orderBy(F.desc("s_acctbal"), "s_suppkey")
    top = table(spark, folder, "supplier").withColumn("r", F.row_number().over(place)).where("r <= 3")
    sites = top.groupBy(F.col("s_nationkey").alias("id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "s_name"))), lambda s: s["s_name"]).alias("sentinel_hospitals")
    )
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("r_regionkey"))
    provinces = table(spark, folder, "region").withColumnRenamed("r_name", "province")
    regions = (
        nations.join(provinces, "r_regionkey")
        .drop("r_regionkey")
        .join(status, "id")
        .join(disease, "id")
        .join(people, "id", "left")
        .join(sites, "id", "left")
        .withColumn("latitude", 23.4 + F.col("id") * 0.5)
        .withColumn("longitude", 60.5 + F.col("id") * 0.7)
    )
    return saved_table(regions, "regions")
