"""Stored marts: where they lie, how days are replaced, how they are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import marts
from ledgerline.sinks.writers import replace_days

BY_DAY = ["txn_date"]
TYPES = {
    "totals": "region string, channel string, txn_count long, flagged_count long, score_sum long, score_count long, txn_date date",
    "risky": "account_id string, mcc_code string, txn_count long, amount decimal(20,2), any_velocity boolean, txn_date date",
    "alerted": "account_id string, country_code string, flagged_count long, amount decimal(20,2), max_score double, txn_date date",
    "discrepant": "discrepancy_type string, resolved boolean, row_count long, variance decimal(20,2), txn_date date",
}


def _of(df: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    return df.where(F.col("txn_date").isin(list(days)))


def refresh(spark: SparkSession, root: str, days: Sequence[dt.date], gold: DataFrame | None = None, alerts: DataFrame | None = None,
            disc: DataFrame | None = None) -> None:
    """Replace ``days`` in the marts of the given stored tables, also by nothing.

    The tables are partitioned by ``txn_date``, so only those days are read.
    """
    work = []
    if gold is not None:
        work += [("totals", marts.totals(_of(gold, days))), ("risky", marts.risky(_of(gold, days)))]
    if alerts is not None:
        work.append(("alerted", marts.alerted(_of(alerts, days))))
    if disc is not None:
        work.append(("discrepant", marts.discrepant(_of(disc, days))))
    for name, rows in work:
        # partial sums of a day are few rows: one file a day
        replace_days(spark, rows, f"{root}/{name}", BY_DAY, days)


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(TYPES[name]).parquet(f"{root}/{name}")
