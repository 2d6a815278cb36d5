"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the caller; this module only reads
``spark.checkpoint.dir`` from it.  A private folder is set only when the
setting is missing (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins at runtime (broadcast only
# after the shuffle has measured a side), splits skewed join partitions and
# coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Suggested settings for a large cluster (100 TB inputs): many initial shuffle
# partitions that AQE coalesces to ~256 MB each, scan splits of 256 MB, and a
# broadcast limit that AQE applies to measured (not estimated) sizes.  Nothing
# applies them here; a cluster's session is made by its caller.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


# Rows that Spark hands to a Python task at once; an executor and its workers hold
# each batch several times over.  Spark's own bound is 64 MB.
ARROW_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "covenant") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of Arrow batches in this session, from now on; a value that the caller set stays."""
    key, value = ARROW_BATCH
    if key not in spark.conf.getAll:
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; set one only when unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="covenant-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # some deployments reject setting core confs at runtime
            pass
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    """The path and its filesystem, as Spark's writers resolve them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any filesystem Spark writes to; a missing one is no error."""
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root, unique per call."""
    return f"{checkpoint_root(spark)}/covenant/{name}-{uuid.uuid4().hex[:12]}"
