"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job needs: UTC instants, adaptive execution with skew handling,
# and whole-stage code generation capped at HotSpot's JIT limit (8000 bytes of
# bytecode per method): a larger fused stage would run in the bytecode
# interpreter, so Spark falls back to per-operator code, whose methods are
# split small enough to be compiled.
REQUIRED_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library depends on (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, its checkpoints as change logs: a micro-batch reads and writes the keys it
    touches, not the whole state."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (the UI stays off)."""
    master = master or os.environ.get("TIDEWATER_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEWATER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    Only a session in one local process (tests) that has none gets a scratch
    folder; on a cluster other machines could not read it, so that raises.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
    scratch = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def cluster_conf(input_bytes: int, executor_cores_total: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings sized from the input volume for a cluster run.

    Shuffle partitions start at one per ``target_partition_bytes`` of input
    (never fewer than 2 x total cores) and adaptive execution coalesces small
    ones at runtime; scans split at the same size.  Broadcasts stay behind the
    default runtime size check."""
    parts = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        **REQUIRED_CONF,
    }
