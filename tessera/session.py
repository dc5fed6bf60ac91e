"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster (~100 TB inputs, ~1000 executors).  Shuffles
# start wide and AQE coalesces them to ~256 MB partitions, splits skewed join
# partitions, and file splits stay at 256 MB so a scan task fits in executor
# memory.  Apply with ``builder.config(map=CLUSTER_CONF)`` or spark-defaults;
# ``spark.checkpoint.dir`` must name a folder every executor can reach.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_session(app: str = "tessera") -> SparkSession:
    """A session for a cluster: ``CLUSTER_CONF`` on top of what the launcher set."""
    builder = SparkSession.builder.appName(app)
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session tuned for the fixture sizes (tests, bench)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder used to cut lineage and to stage files.

    On a cluster this is ``spark.checkpoint.dir`` (or whatever the application
    set with ``setCheckpointDir``), a folder every executor can reach.  Only a
    local-mode session with nothing configured gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; iterative operators need a shared folder to cut lineage"
            )
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared folder (never reused).

    All paths of an application lie in one folder, which goes when its JVM ends.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _roots:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-{uuid.uuid4().hex}"
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _roots[app] = root
    return f"{_roots[app]}/{name}-{uuid.uuid4().hex}"
