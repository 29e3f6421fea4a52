"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Settings every job relies on. All can be changed on a running session.
RUNTIME_CONF = {
    # Weather hours are instants and pickups are wall clock, so both must be
    # read in one zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Lookup joins carry no hint: Spark broadcasts a side only below its size
    # threshold, and otherwise sort-merges and splits hot keys.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split them even where an aggregate or window on the join key follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to a session that already runs."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "cabgrid", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Slot tables have 168 folders; listing those is no job of its own here.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach; the same rule on every master.

    ``spark.checkpoint.dir`` where it is set, else the folder given to
    ``SparkContext.setCheckpointDir``, else ``_scratch`` in the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write to the shared folder where no folder is set yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one folder made by ``scratch_path``; anything outside the shared folder is refused."""
    if not path.startswith(f"{shared_dir(spark)}/"):
        raise ValueError(f"{path} is not in the shared folder")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
