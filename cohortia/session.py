"""Spark session helpers.

The session is the only place where execution knobs live.  Operators never set
configuration themselves; they rely on AQE (coalescing, skew-join splitting,
runtime broadcast conversion) being on, which is the Spark 4 default.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # sessions of a hot user are merged before the shuffle
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Streaming state off the JVM heap: the (slot, user) state of the chained
# aggregation grows with active users, which on a cluster is millions of keys.
STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "hdfs": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "cohortia",
                shuffle_partitions: int | None = None,
                conf: dict | None = None, state_store: str = "rocksdb") -> SparkSession:
    """Build (or reuse) a session with the defaults the operators expect."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.streaming.stateStore.providerClass", STATE_STORES[state_store])
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortia-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df):
    """Write a *reduced* intermediate once and return a DataFrame reading it back.

    Used where one small derived table (distinct values, one row per user or
    post) feeds several branches of a plan: every branch then reads the
    written files instead of re-deriving them from the raw events, and the
    lineage is cut.  Reliable ``checkpoint()`` into ``spark.checkpoint.dir``
    (a shared folder on a cluster) survives executor loss.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               executor_memory_gb: float, target_partition_mb: int = 256) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of parquet.

    * scan splits: ``maxPartitionBytes`` = target_partition_mb, so a 100 TB scan is
      ~400k tasks of 256 MB (decoded rows stay well inside a core's memory share);
    * shuffle: every shuffle here follows column pruning and map-side partial
      aggregation, so it carries a small fraction of the input (assumed ≤ 1/16);
      the partition count covers that at ~target_partition_mb each, clamped to
      2–8× the cores (more reducers would multiply shuffle blocks, M × R, with
      no gain) and rounded to a multiple of the cores; AQE coalesces small
      partitions (advisory size) and splits skewed partitions of joins;
    * the memory share per core bounds the target: a partition must fit into
      (executor memory × 0.6 unified fraction) / cores several times over.
    """
    cores = executors * cores_per_executor
    per_core_mb = executor_memory_gb * 1024 * 0.6 / cores_per_executor
    target = int(min(target_partition_mb, max(32, per_core_mb / 4)))
    shuffle = int(input_bytes / 16 / (target * 1024 * 1024))
    shuffle = min(max(shuffle, 2 * cores), 8 * cores)
    shuffle = ((shuffle + cores - 1) // cores) * cores
    return {
        "spark.sql.files.maxPartitionBytes": f"{target}m",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }
