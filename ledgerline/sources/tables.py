"""Readers for the driver's Parquet tables and small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_READS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's read-only tables.

    The DataFrame (file listing and footer schema) is reused within a
    session; the test tables never change while a session runs.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _READS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _READS[key] = df
    return df


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small fixed table as a Catalyst inline table (no Python RDD).

    The plan is a constant, so its size is known to the optimizer and the
    same rows always give the same plan.
    """
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
