"""A ledger of run metrics, filled from the observations of the jobs' own writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = "run_id string, job string, metric string, value long, recorded_at timestamp_ntz"


def record(spark: SparkSession, path: str, run_id: str, job: str, values: dict[str, int], now: dt.datetime) -> None:
    """Append a job's counts; a replayed job adds a later record, which replaces the earlier when read."""
    rows = [(run_id, job, name, None if v is None else int(v), now) for name, v in sorted(values.items())]
    spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The latest value of each metric (run_id, job, metric, value, recorded_at)."""
    rows = spark.read.schema(METRICS).parquet(path)
    last = rows.groupBy("run_id", "job", "metric").agg(F.max_by("value", "recorded_at").alias("value"), F.max("recorded_at").alias("recorded_at"))
    return last


def run_metrics(ledger: DataFrame) -> DataFrame:
    """raw, quarantined, rejected, accepted, Silver and alert counts of each run, from the ledger alone."""
    of = lambda job, metric: F.max(F.when((F.col("job") == job) & (F.col("metric") == metric), F.col("value")))
    return ledger.groupBy("run_id").agg(
        (of("bronze", "bronze_rows") + of("bronze", "quarantined")).alias("raw_rows"),
        of("bronze", "quarantined").alias("quarantined"), of("silver", "rejected").alias("rejected"), of("silver", "accepted").alias("accepted_before_dedup"),
        of("gold", "gold_rows").alias("silver_rows"), of("gold", "alerts").alias("alerts"))
