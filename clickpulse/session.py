"""Session construction and the shared scratch folder.

The scratch folder is the one the cluster names in ``spark.checkpoint.dir``. Only a session
with a local master and no such setting (tests, laptops) gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from clickpulse import storage

# Defaults sized for local[8]; on a cluster the submitter overrides them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (~100 TB inputs, ~1000 executors). AQE coalesces the
# many shuffle partitions down to ~advisory size and splits skewed join partitions;
# RocksDB keeps large streaming state off the JVM heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(
    app: str = "clickpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
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
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, path: str | None = None) -> str:
    """The shared folder for intermediate tables.

    In this order: the context's checkpoint folder, ``spark.checkpoint.dir`` (session, then
    context), ``path``. If none is set, a local master gets a private temporary folder; any
    other master is an error, because executors could not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or path
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="clickpulse-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, marked for removal when the driver's JVM ends.

    A JVM that is killed, as at the end of a plain Python process, leaves the folder in place; clear the
    checkpoint folder between jobs.

    Spark's writers create the folder through the Hadoop file system; nothing is made locally.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/clickpulse/{name}-{uuid.uuid4().hex[:12]}"
    storage.delete_on_exit(spark, path)
    return path


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session for streaming queries with their own state-partition count.

    Stateful operators fix their partition count (``spark.sql.shuffle.partitions``) at the
    first start of a checkpoint and AQE does not coalesce them, so a count sized for big
    batch shuffles would make every micro-batch run that many state tasks. ``newSession``
    shares the SparkContext (executors, cache) but has its own SQL conf, so the caller's
    session is left untouched. Default: the cluster's default parallelism.
    """
    s = spark.newSession()
    n = state_partitions or spark.sparkContext.defaultParallelism
    s.conf.set("spark.sql.shuffle.partitions", str(int(n)))
    return s
