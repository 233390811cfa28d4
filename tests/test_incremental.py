"""Counts that follow a folder of files, against counting all of it."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casecurve.operators.baseline import global_baseline
from casecurve.operators.series import case_series
from casecurve.plans import incremental as inc

STARTED = dt.datetime(2020, 1, 1)


def write(path, seed, n=200):
    rng = random.Random(seed)
    rows = [(rng.choice("abc"), STARTED + dt.timedelta(days=rng.randint(0, 900)), rng.choice(["F", "O"])) for _ in range(n)]
    rows += [("a", None, "F"), (None, STARTED, "F")]
    names = ["kind", "day", "state"]
    pq.write_table(pa.table({k: [r[i] for r in rows] for i, k in enumerate(names)}), path)


def cases(raw):
    return raw.where("state = 'F'").select(F.col("kind").alias("series_id"), F.col("day").alias("event_ts"), inc.FILE)


def counted(spark, ledger, **kw):
    return sorted(map(tuple, inc.counted_series(spark, ledger, **kw).collect()), key=str)


def whole(spark, folder):
    raw = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    plain = raw.select(F.col("kind").alias("series_id"), F.col("day").alias("event_ts"), F.col("state").alias("status"))
    return sorted(map(tuple, case_series(plain, word="f").collect()), key=str)


def test_new_replaced_and_removed_files(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    (folder / "sub").mkdir(parents=True)

    def update():
        return inc.update_counts(spark, str(folder), ledger, cases)

    write(folder / "one.parquet", 1)
    write(folder / "sub" / "two.parquet", 2)
    assert update() == inc.Run(0, 2, 0, 0)
    assert counted(spark, ledger) == whole(spark, str(folder))
    first = counted(spark, ledger)
    assert update() == inc.Run(0, 0, 0, 2)

    write(folder / "three.parquet", 3)
    write(folder / "one.parquet", 4, n=350)  # same path, other rows
    assert update() == inc.Run(1, 2, 1, 1)
    assert counted(spark, ledger) == whole(spark, str(folder))
    assert counted(spark, ledger, version=0) == first

    os.rename(folder / "sub" / "two.parquet", folder / "moved.parquet")
    (folder / "three.parquet").unlink()
    assert update() == inc.Run(2, 1, 2, 1)
    assert counted(spark, ledger) == whole(spark, str(folder))

    assert inc.compact(spark, ledger).version == 3
    assert counted(spark, ledger) == whole(spark, str(folder))
    assert update() == inc.Run(3, 0, 0, 2)
    baseline, _ = inc.current_baselines(spark, ledger)
    raw = spark.read.parquet(str(folder)).select(F.col("kind").alias("series_id"), F.col("day").alias("event_ts"), F.col("state").alias("status"))
    assert sorted(map(tuple, baseline.collect()), key=str) == sorted(map(tuple, global_baseline(case_series(raw, word="f")).collect()), key=str)

    shutil.rmtree(folder)
    assert update() == inc.Run(4, 0, 2, 0)
    assert counted(spark, ledger) == []


def test_only_new_files_are_read(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    for i in range(3):
        write(folder / f"{i}.parquet", i)
    inc.update_counts(spark, str(folder), ledger, cases)
    write(folder / "3.parquet", 3)
    seen = []

    def watching(raw):
        seen.append(raw.select(inc.FILE).distinct().count())
        return cases(raw)

    inc.update_counts(spark, str(folder), ledger, watching)
    assert seen == [1]


def test_a_broken_run_changes_nothing(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    write(folder / "0.parquet", 0)
    inc.update_counts(spark, str(folder), ledger, cases)
    before = counted(spark, ledger)
    write(folder / "1.parquet", 1)
    bad = cases
    with pytest.raises(Exception, match="broken"):
        inc.update_counts(spark, str(folder), ledger, lambda raw: bad(raw).withColumn("event_ts", F.raise_error(F.lit("broken")).cast("timestamp")))
    assert counted(spark, ledger) == before
    # A manifest that was not finished does not count either.
    os.makedirs(f"{ledger}/manifest/version=7")
    assert counted(spark, ledger) == before
    assert inc.update_counts(spark, str(folder), ledger, cases).read == 1
    assert counted(spark, ledger) == whole(spark, str(folder))
    with pytest.raises(ValueError, match="no manifest"):
        inc.manifest(spark, ledger, 99)
