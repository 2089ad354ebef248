"""Session helpers.

The library never creates a session on a cluster: every operator takes the
caller's ``SparkSession``.  ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "reelstar", warehouse: str | None = None) -> SparkSession:
    """A local session configured like the cluster defaults we rely on."""
    builder = SparkSession.builder
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    event_log = os.environ.get("REELSTAR_EVENT_LOG_DIR")
    if event_log:  # stage and task times for offline reading, no UI
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log))
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", os.environ.get("REELSTAR_BROADCAST_BYTES", "10m"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints",
                os.environ.get("REELSTAR_CLEAN_CHECKPOINTS", "true"))
        .config("spark.driver.memory", os.environ.get("REELSTAR_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at ~one per ``target_partition_bytes`` of input
    (at least two waves of tasks) and AQE coalesces small ones and splits
    skewed ones at runtime; broadcasts stay size-checked by Spark.
    """
    slots = executors * cores_per_executor
    partitions = max(2 * slots, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        # lineage cuts write whole tables to the checkpoint folder; delete them
        # once their DataFrames are garbage-collected on the driver
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking it from the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; we only pick
    a folder of our own when nothing is configured and the master is local
    (tests), because a machine-local folder is useless across executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running this job")
    folder = tempfile.mkdtemp(prefix="reelstar-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to a new folder below the shared checkpoint folder, and read from there."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage_all(dfs: list[DataFrame]) -> list[DataFrame]:
    """Checkpoint independent DataFrames as concurrent jobs (one submitting
    thread each), so small jobs share the cluster instead of queueing."""
    from concurrent.futures import ThreadPoolExecutor
    if not dfs:
        return []
    ensure_checkpoint_dir(dfs[0].sparkSession)
    with ThreadPoolExecutor(max_workers=len(dfs)) as pool:
        return list(pool.map(cut_lineage, dfs))
