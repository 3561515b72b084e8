"""Session helpers: a sensibly configured session and the shared scratch root."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every quiver job relies on.  AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast when a side turns out small, skewed partitions split).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "quiver", extra: dict | None = None) -> SparkSession:
    """``shuffle_partitions`` is left to the deployment unless given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage; without it nothing
    that all executors see is known, so this raises.  In local mode, where
    driver and executor are one process, an unset folder is made under /tmp.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quiver-ckpt-", dir="/tmp")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory name under the checkpoint root (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/quiver/{spark.sparkContext.applicationId}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what this application materialised; frames built on it are
    unusable afterwards, so call it when the job is done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df):
    """Compute ``df`` once and cut its lineage: write it as a parquet table
    under the shared checkpoint folder (see :func:`checkpoint_root`) and read
    it back.  Used for frames several branches of a plan read and for small
    intermediate results a driver-side loop inspects.  The file scan gives
    AQE exact sizes, and the result survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, "materialized")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
