"""Which partitions of a table hold which keys: an append-only index beside the table.

One row (hash of the key, partition value) for each key and partition that ever
held it, stored by buckets of the hash.  An upsert asks the index instead of
scanning the table: it reads a hash and a partition value per key, and of those
only the buckets its updates fall into.  Entries are added before the data are
published and never removed, so after a crash the index may name a partition too
many, which costs a rewrite of that partition, but never one too few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.runtime import path_exists

BUCKETS = 64


def index_path(table_path: str) -> str:
    return table_path.rstrip("/") + "_keys"


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _entries(df: DataFrame, keys: Sequence[str], partition_col: str, buckets: int) -> DataFrame:
    h = key_hash(keys)
    return df.select(h.alias("key_hash"), F.col(partition_col).alias("part"), F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"))


def build(df: DataFrame, path: str, keys: Sequence[str], partition_col: str, buckets: int = BUCKETS) -> None:
    """Index a whole table (reads the key and partition columns only)."""
    (_entries(df, keys, partition_col, buckets).distinct().hint("rebalance", "bucket").sortWithinPartitions("bucket", "key_hash")
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def read(spark: SparkSession, path: str, part_type: T.DataType) -> DataFrame:
    kind = T.StructType([T.StructField("key_hash", T.LongType()), T.StructField("part", part_type), T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(kind).parquet(path)


def locate_and_extend(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], partition_col: str,
                      buckets: int = BUCKETS) -> list:
    """Values of every partition that holds, or held, a key of ``updates`` or gets one now; new entries are appended.

    ``updates`` is a stored table with one row a key.  The list is bounded by the number of partitions.
    """
    new = _entries(updates, keys, partition_col, buckets)
    mine = [r[0] for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
    known = read(spark, path, updates.schema[partition_col].dataType).where(F.col("bucket").isin(mine))
    held = known.join(new.select("bucket", "key_hash"), ["bucket", "key_hash"], "left_semi")
    parts = [r[0] for r in held.select("part").union(new.select("part")).distinct().collect()]
    fresh = (new.alias("n").join(held.alias("h"), (F.col("n.bucket") == F.col("h.bucket")) & (F.col("n.key_hash") == F.col("h.key_hash"))
                                 & F.col("n.part").eqNullSafe(F.col("h.part")), "left_anti"))
    fresh.hint("rebalance", "bucket").sortWithinPartitions("bucket", "key_hash").write.mode("append").partitionBy("bucket").parquet(path)
    return parts


def ensure(spark: SparkSession, table: DataFrame, path: str, keys: Sequence[str], partition_col: str) -> None:
    """Build the index of a table that has none yet."""
    if not path_exists(spark, path + "/_SUCCESS"):
        build(table, path, keys, partition_col)
