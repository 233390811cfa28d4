"""Stores of batches that can be repeated."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from casecurve.sources import snapshots as sn

SCHEMA = "id bigint, at timestamp, tags array<string>, note string"


def rows(spark, low, high):
    made = spark.range(low, high).withColumn("at", F.timestamp_seconds(F.col("id") * 1000))
    return made.select("id", "at", F.array(F.lit("a"), F.lit("é")).alias("tags"), F.when(F.col("id") % 2 == 0, "x").alias("note")).repartition(3)


def ids(spark, path, version=None):
    return sorted(r.id for r in sn.read_snapshot(spark, path, SCHEMA, version).collect())


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "store")
    assert ids(spark, path) == [] and sn.batches(path) == {}
    sn.write_batch(rows(spark, 0, 10), path, "monday")
    sn.write_batch(rows(spark, 10, 30), path, "tuesday")
    sn.write_batch(rows(spark, 0, 10), path, "monday")  # a rerun
    assert ids(spark, path) == list(range(30))
    assert sn.batches(path) == {"monday": 10, "tuesday": 20}
    assert sn.versions(path) == [0, 1] and ids(spark, path, 0) == list(range(10))
    listed = {f for b in sn.snapshot(path, 1)["batches"] for f in b["files"]}
    assert {f"data/{n}" for n in os.listdir(tmp_path / "store" / "data") if n.endswith(".parquet")} == listed
    got = sn.read_snapshot(spark, path, SCHEMA).where("id = 4").first()
    assert (got.at.timestamp(), got.tags, got.note) == (4000.0, ["a", "é"], "x")


def test_a_broken_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    sn.write_batch(rows(spark, 0, 5), path, "good")
    bad = rows(spark, 5, 50).withColumn("note", F.when(F.col("id") == 40, F.raise_error(F.lit("broken"))).otherwise(F.col("note")))
    with pytest.raises(Exception, match="broken"):
        sn.write_batch(bad, path, "bad")
    assert ids(spark, path) == list(range(5)) and sn.versions(path) == [0]
    sn.write_batch(rows(spark, 5, 50), path, "bad")
    assert ids(spark, path) == list(range(50))


def test_files_of_lost_tasks_and_drafts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    sn.write_batch(rows(spark, 0, 5), path, "good")
    rows(spark, 90, 95).coalesce(1).write.parquet(str(tmp_path / "other"))
    part = next(n for n in os.listdir(tmp_path / "other") if n.endswith(".parquet"))
    os.rename(tmp_path / "other" / part, tmp_path / "store" / "data" / "left.parquet")
    (tmp_path / "store" / "snapshots" / ".draft").write_text("{")
    assert ids(spark, path) == list(range(5))


def test_overwrite_empty_batches_and_options(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    sn.write_batch(rows(spark, 0, 5), path, "a")
    sn.write_batch(rows(spark, 0, 0), path, "none")
    assert sn.batches(path) == {"a": 5, "none": 0}
    sn.write_batch(rows(spark, 7, 9), path, "b", overwrite=True)
    assert ids(spark, path) == [7, 8] and sn.batches(path) == {"b": 2} and ids(spark, path, 1) == list(range(5))
    with pytest.raises(Exception, match="are needed"):
        rows(spark, 0, 1).write.format(sn.FORMAT).mode("append").option("path", path).save()
    with pytest.raises(Exception, match="Unrecognized filesystem"):
        sn.located("nowhere://x/y")
