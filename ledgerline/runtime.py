"""Session-level helpers: shared scratch space and size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_LOCAL_ROOT: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Jobs write staging tables and checkpoints below it so they survive the
    loss of an executor.  Only when the session names no such folder (local
    tests) do we create one and register it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_ROOT.get(id(spark))
    if not root:
        try:
            jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
            root = jdir.get() if jdir.isDefined() else None
        except Exception:  # noqa: BLE001 - no JVM context (e.g. a remote session)
            root = None
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        _LOCAL_ROOT[id(spark)] = root
        try:
            spark.sparkContext.setCheckpointDir(root)
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:  # noqa: BLE001 - core conf may be read-only at run time
            pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path or URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def plan_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of a frame's size: file sizes for scans, their product for joins.  Runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` only if its optimised plan is estimated at ``max_bytes`` at most.

    Beyond the bound the frame is returned unchanged and the planner picks a
    shuffle join (AQE can still convert it at run time from real sizes).
    Parquet sizes are compressed, so callers leave room for several times
    ``max_bytes`` in memory.
    """
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def cluster_conf(input_bytes: int, executor_cores: int, executor_memory_gb: int,
                 target_partition_mb: int = 256, max_partitions: int = 50_000) -> dict[str, str]:
    """Session settings sized for the data (set them when building the session).

    * file splits of ``target_partition_mb`` so a scan task reads a bounded
      slice whatever the table size;
    * initial shuffle partitions = input / target, never below 2x the cores
      of the cluster share and never above ``max_partitions`` (a plan's
      map-output table and a stream's state stores grow with it; beyond it
      partitions get larger and spill); AQE then coalesces small ones and
      splits skewed ones (skew join), and ``rebalance`` writes get
      advisory-sized files;
    * the broadcast threshold stays at the reference's 50 MB; our own
      dimension broadcasts are additionally bounded by the plan's bytes;
    * stream state lives in RocksDB rather than on the JVM heap.

    With 4 GB per core and 256 MB partitions a task holds well under its
    memory share, so sorts and aggregations spill rarely.
    """
    mb = 1024 * 1024
    parts = min(max_partitions, max(2 * executor_cores, -(-int(input_bytes) // (target_partition_mb * mb))))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb * mb),
        "spark.sql.files.maxPartitionBytes": str(target_partition_mb * mb),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.autoBroadcastJoinThreshold": str(50 * mb),
        "spark.sql.parquet.compression.codec": "snappy",
        # keyed stream state (velocity, dedup) off the JVM heap
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.session.timeZone": "UTC",
        "spark.executor.cores": str(executor_cores),
        "spark.executor.memory": f"{executor_memory_gb}g",
    }


def ship_package(spark: SparkSession) -> str:
    """Make ``ledgerline`` importable on executors (``addPyFile`` of a zip).

    Needed by the Python-side pieces (the streaming state function); the
    batch plans run in the JVM only.  The zip is built once per session on
    the driver and distributed by Spark.
    """
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ledgerline-pkg-"), "ledgerline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    return out
