"""Account statistics as a versioned table: a folder for each version, complete ones only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.runtime import file_system, path_exists

SCHEMA = "account_id string, n_amt long, s_amt decimal(28,2), s_sq struct<hi:decimal(30,0),lo:decimal(30,0)>"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions, oldest first (a folder listing)."""
    if not path_exists(spark, path):
        return []
    fs, root = file_system(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n.removeprefix("version=")) for n in found if n.startswith("version=") and path_exists(spark, f"{path}/{n}/_SUCCESS"))


def latest(spark: SparkSession, path: str) -> int:
    """The newest complete version; 0 (no statistics) if there is none."""
    return max(versions(spark, path), default=0)


def publish(spark: SparkSession, stats: DataFrame, path: str) -> int:
    """Store ``scoring.account_stats`` as the next version; running streams take it up with their next batch."""
    version = latest(spark, path) + 1
    stats.write.mode("overwrite").parquet(f"{path}/version={version}")  # overwrite: what a crash left unfinished
    return version


def read(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.createDataFrame([], SCHEMA) if version == 0 else spark.read.schema(SCHEMA).parquet(f"{path}/version={version}")


def expire(spark: SparkSession, path: str, keep: int = 3) -> list[int]:
    """Delete all but the newest ``keep`` versions; those that recorded batches may still be replayed with must stay."""
    gone = versions(spark, path)[:-keep] if keep > 0 else []
    for v in gone:
        fs, p = file_system(spark, f"{path}/version={v}")
        fs.delete(p, True)
    return gone
