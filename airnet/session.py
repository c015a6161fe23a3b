"""Spark session helpers.

The library never creates a session on its own inside an operator; jobs, tests and the
benchmark call :func:`get_session`.  On a cluster the caller's session is used as is.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on: UTC wall clock (timestamps compare with
# the SQL oracle), ANSI on (errors instead of silent NULLs; operators use try_* forms
# where a NULL is meant), AQE for runtime broadcast / skew-join / partition coalescing.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "airnet",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    Master and memory stay as the submit command or the cluster set them.  Only a ``master``
    given here is set, with driver memory for it from $AIRNET_DRIVER_MEMORY (16g).
    """
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master:
        b = b.master(master)
        conf.setdefault("spark.driver.memory", os.environ.get("AIRNET_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring the context if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value is used.
    Only when it is unset *and* Spark runs in local mode (tests, local benchmark) a folder
    below the warehouse serves.  On a cluster without the setting this raises: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the checkpoint folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df, path: str):
    """Write ``df`` as parquet and read it back.  The shuffle files of the write go when it ends, as no later
    plan reads them; else they stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
    return spark.read.parquet(path)


def materialize(df, label: str = "state"):
    """Cut lineage by writing ``df`` as parquet into the shared checkpoint folder and
    reading it back: one job computes the rows once, later plans start from the files,
    and the files survive the loss of any executor."""
    return write_once(df, scratch_path(df.sparkSession, label))
