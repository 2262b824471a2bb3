"""Session settings, and where a job may keep intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: SQL settings every job of this package relies on. All can be set at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot order id is split even when the aggregate after the join then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Where every partition of a side is this small, a hash table of it is cheaper than sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(shuffled_bytes: int, at_least: int) -> int:
    """Shuffle partitions of about 128 MB each."""
    return max(at_least, -(-shuffled_bytes // TARGET_PARTITION_BYTES))


def size_shuffles(spark: SparkSession, shuffled_bytes: int) -> None:
    """Start shuffles with enough partitions for the given amount, so that none has to spill.

    Adaptive execution merges partitions that turn out small, so a generous amount is cheap.
    """
    usual = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    wanted = shuffle_partitions_for(shuffled_bytes, usual)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))


def local_session(name: str = "tidemark", cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        # Call sites in error messages cost a round trip per expression, half the time of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Without the setting, a checkpoint folder set on the context is used. A local session with neither gets a fresh temporary
    folder; on a cluster one of them is required, because a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table inside the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
