"""File scans with explicit schemas (JSON lines, partitioned and evolving Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions.timefn import parse_iso_utc


def scan_json(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW_EVENT) -> DataFrame:
    """A1: newline-delimited JSON, explicit schema, malformed lines kept.

    A line that does not parse yields NULL fields and its text in
    ``_corrupt_record`` (PERMISSIVE mode), so nothing is dropped silently.
    Timestamps are read as text and parsed as ISO-8601 with optional fraction
    and offset, normalised to UTC; a record whose timestamp is none of that is
    marked corrupt with its fields as JSON.
    """
    full = T.StructType(iso_as_text(schema).fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = (spark.read.schema(full)
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .json(path))
    stamps = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    unread = F.lit(False)
    for name in stamps:
        unread = unread | (F.col(name).isNotNull() & parse_iso_utc(name).isNull())
    broken = F.coalesce(F.col("_corrupt_record"), F.when(unread, F.to_json(F.struct(*schema.names))))
    return raw.withColumns({"_corrupt_record": broken} | {name: parse_iso_utc(name) for name in stamps})


def iso_as_text(schema: T.StructType) -> T.StructType:
    """``schema`` with its TIMESTAMP_NTZ fields as text, to be parsed by ``parse_iso_utc``."""
    return T.StructType([T.StructField(f.name, T.StringType()) if isinstance(f.dataType, T.TimestampNTZType) else f
                         for f in schema.fields])


def scan_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A2: partitioned Parquet; partition columns come back from the paths.

    Filters on partition columns prune directories; other filters and the
    projection are pushed into the Parquet reader.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def scan_merge_schema(spark: SparkSession, path: str) -> DataFrame:
    """A3 + P17: union of the file schemas, plus the event date."""
    return (spark.read.option("mergeSchema", "true").parquet(path)
            .withColumn("txn_date", F.to_date("transaction_ts")))


def scan_current(spark: SparkSession, path: str) -> DataFrame:
    """A5: the current rows of a history table (``valid_to`` unset)."""
    df = spark.read.parquet(path)
    return df.filter(F.col("valid_to").isNull()) if "valid_to" in df.columns else df
