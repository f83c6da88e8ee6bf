"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.runtime import scratch_path, ship_package

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once per application)."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        ship_package(spark)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage, so that a lost executor costs the tasks of the next
    step at most, and gives the planner the real size of the data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_broadcast(df: DataFrame, max_bytes: int) -> DataFrame:
    """Broadcast a stored table if its files hold at most ``max_bytes``.

    Beyond the bound the frame comes back unchanged and joins shuffle.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def crc_mod(col: str, n: int) -> Column:
    """crc32 of an id as text, modulo n; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], name: str = "text", limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``name`` holds about ``limit`` bytes in each (one row at least)."""
    for b in batches:
        if b.num_rows and b.column(name).nbytes > limit:
            step = max(1, b.num_rows * limit // b.column(name).nbytes)
            for at in range(0, b.num_rows, step):
                yield b.slice(at, step)
        elif b.num_rows:
            yield b
