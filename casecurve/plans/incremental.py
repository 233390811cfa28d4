"""Counts and baselines that follow a folder of line-list files without reading it all again.

A ledger folder holds two kinds of tables. ``counts/batch=k`` has the cases of the files that run k read, one row
per file, series and period. ``manifest/version=k`` names the files that count, with the size and time they
had when read and the batch that holds their rows. A run lists the folder, reads only the files that the
manifest does not know as they are now, and writes a batch and then a manifest. Files that have gone or were
replaced drop out of the manifest, and with it their rows out of every sum: nothing is edited in place,
and a run that breaks off leaves the last manifest as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casecurve.functions.dates import period_start
from casecurve.operators.baseline import global_baseline, seasonal_baseline
from casecurve.operators.series import KEYS, fill_gaps
from casecurve.session import saved_table

_MANIFEST = "path string, modified timestamp, length bigint, batch int"
FILE = "_file"


@dataclass
class Run:
    """What a run did: the manifest version that holds now, and how many files were read, dropped and left alone."""

    version: int
    read: int
    dropped: int
    kept: int


def _listed(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """``path, modified, length`` of the folder's files; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.load(folder).select("path", F.col("modificationTime").alias("modified"), "length")


def _versions(spark: SparkSession, ledger: str) -> list[int]:
    """Manifest versions that were written to their end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger}/manifest")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path)]
    done = [p.getName() for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(name.split("=")[1]) for name in done if name.startswith("version="))


def manifest(spark: SparkSession, ledger: str, version: int | None = None) -> DataFrame:
    """The files that count, of the newest version or a given one."""
    known = _versions(spark, ledger)
    if not known:
        return spark.createDataFrame([], _MANIFEST)
    wanted = known[-1] if version is None else version
    if wanted not in known:
        raise ValueError(f"no manifest version {wanted}")
    return spark.read.schema(_MANIFEST).parquet(f"{ledger}/manifest/version={wanted}")


def update_counts(
    spark: SparkSession,
    folder: str,
    ledger: str,
    cases: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = KEYS,
    period: str = "month",
    pattern: str = "*.parquet",
) -> Run:
    """Brings the ledger up to the files that ``folder`` holds now.

    ``cases`` turns the rows of the files into ``keys, event_ts`` of the cases that count and keeps the column
    ``_file``. A file is known by path, time and size. One writer at a time. The driver sees the paths of new
    files, as for any read, and no rows. Without any change nothing is written.
    """
    known = manifest(spark, ledger)
    versions = _versions(spark, ledger)
    version = versions[-1] + 1 if versions else 0
    try:
        listed = _listed(spark, folder, pattern)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = known.drop("batch").limit(0)
    now = saved_table(listed, "listed")
    unchanged = saved_table(known.join(now, ["path", "modified", "length"], "left_semi").select(*known.columns), "unchanged")
    fresh = now.join(unchanged, "path", "left_anti")
    paths = [r.path for r in fresh.select("path").collect()]
    n_known, n_kept = known.count(), unchanged.count()
    if not paths and n_known == n_kept:
        return Run(version - 1, 0, 0, n_kept)
    if paths:
        rows = cases(spark.read.parquet(*paths).withColumn(FILE, F.col("_metadata.file_path"))).where(F.col("event_ts").isNotNull())
        counted = rows.groupBy(FILE, *keys, period_start(F.col("event_ts"), period).alias("ds")).agg(F.count(F.lit(1)).alias("y"))
        counted.write.mode("overwrite").parquet(f"{ledger}/counts/batch={version}")
    entries = unchanged.unionByName(fresh.withColumn("batch", F.lit(version)))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/manifest/version={version}")
    return Run(version, len(paths), n_known - n_kept, n_kept)


def counted_series(spark: SparkSession, ledger: str, keys: Sequence[str] = KEYS, period: str = "month", version: int | None = None) -> DataFrame:
    """The gap-free series of all files that count, from the stored rows alone.

    A file's rows are taken from the batch that its manifest entry names, so rows of an earlier state of it do not
    count. ``version`` gives the series as it was then. A ledger without a run is an error.
    """
    entries = manifest(spark, ledger, version).select(F.col("path").alias("_path"), F.col("batch").alias("_batch"))
    stored = spark.read.option("basePath", f"{ledger}/counts").parquet(f"{ledger}/counts")
    counting = stored.join(entries, (F.col("_path") == F.col(FILE)) & (F.col("_batch") == F.col("batch")), "left_semi")
    return fill_gaps(counting.groupBy(*keys, "ds").agg(F.sum("y").alias("y")), keys, period)


def current_baselines(spark: SparkSession, ledger: str, keys: Sequence[str] = KEYS) -> tuple[DataFrame, DataFrame]:
    """Global and month-of-year baselines of the counted series."""
    series = saved_table(counted_series(spark, ledger, keys), "series")
    return global_baseline(series, keys), seasonal_baseline(series, keys)


def compact(spark: SparkSession, ledger: str, keys: Sequence[str] = KEYS) -> Run:
    """Writes the rows of all files that count into one batch; earlier versions stay readable."""
    versions = _versions(spark, ledger)
    version = versions[-1] + 1
    entries = manifest(spark, ledger)
    stored = spark.read.option("basePath", f"{ledger}/counts").parquet(f"{ledger}/counts")
    at = (F.col("path") == F.col(FILE)) & (entries["batch"] == stored["batch"])
    stored.join(entries, at, "left_semi").select(FILE, *keys, "ds", "y").write.mode("overwrite").parquet(f"{ledger}/counts/batch={version}")
    entries.withColumn("batch", F.lit(version)).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/manifest/version={version}")
    return Run(version, 0, 0, entries.count())
