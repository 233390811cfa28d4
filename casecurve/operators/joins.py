"""Joins by shared columns, with a preferred side, and round-robin assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casecurve.operators.running import numbered
from casecurve.session import saved_table


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on every column name the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left.join(right, shared, how)


def prefer_first(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``first`` and those rows of ``second`` whose key it does not have.

    ``first`` is read twice and should be a table or cheap to compute.
    """
    return first.unionByName(second.join(first.select(*keys), list(keys), "left_anti"))


def assign_round_robin(rows: DataFrame, targets: DataFrame, position: str, target_key: str, output: str) -> DataFrame:
    """Gives row number i the (i mod n)-th of the n targets, by a numeric row position and key.

    The targets are numbered in parallel and saved, so that their size decides the join.
    """
    ranked = numbered(saved_table(targets.select(target_key), "targets"), target_key)
    ranked = saved_table(ranked.select(F.col(target_key).alias(output), F.col("position").alias("_slot")), "targets")
    n = ranked.agg(F.count(F.lit(1))).scalar()
    return rows.withColumn("_slot", F.pmod(F.col(position), n)).join(ranked, "_slot", "left").drop("_slot")


def agreement(intakes: DataFrame, predicted: str = "predicted_disease", confirmed: str = "doctor_confirmed_disease") -> DataFrame:
    """Adds ``agrees``: whether prediction and confirmation match, null while unconfirmed."""
    return intakes.withColumn("agrees", F.col(predicted) == F.col(confirmed))
