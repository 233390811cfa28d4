"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Safe everywhere: none of these fixes a machine, a path or a memory size.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "casecurve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and Arrow; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; in local mode a scratch one if it is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="casecurve-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for this application in the shared folder."""
    return f"{shared_folder(spark)}/casecurve-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _removed_at_end(spark: SparkSession, folder: str) -> None:
    """The application's folder of saved tables goes when its driver's file systems are closed."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)


def saved_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage durably, fixes values later stages must agree on, and gives the optimizer the
    real byte size: a following join broadcasts the table only if it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles (with skew splitting) beyond it.
    All tables of an application share one folder, which is removed when it ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    _removed_at_end(spark, path.rsplit("/", 1)[0])
    return spark.read.schema(df.schema).parquet(path)
