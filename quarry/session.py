"""Session construction and the shared scratch location.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir`` (or whatever ``SparkContext.setCheckpointDir`` was
given).  Only a local-mode session without one (tests, the bench) gets a fresh
temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of staged inputs are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "quarry",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  A
    local-mode session with neither gets a private temporary folder; a cluster
    session with neither is an error, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/quarry-scratch/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever Spark finds it."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def split_count(df) -> int:
    """Number of partitions ``df`` is planned over (shuffle partitions when
    the session cannot expose its RDD, e.g. a remote session)."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def core_count(spark: SparkSession) -> int:
    """Default parallelism of the cluster (shuffle partitions when unknown)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
