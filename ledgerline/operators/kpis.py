"""KPI roll-ups and the report queries over Gold / alerts / discrepancies.

Report dates are relative to an explicit ``as_of`` run date (whole days,
inclusive) so every report is reproducible.  Filters compare the bare
``txn_date`` column with literals, which lets Parquet partition pruning and
row-group pushdown apply when the tables are read from storage.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import avg_of_scaled, round_ratio
from ledgerline.functions.timefn import days_before
from ledgerline.operators.enrich import dedup_dim
from ledgerline.params import DIM_BROADCAST_MAX_BYTES
from ledgerline.runtime import bounded_broadcast
from ledgerline.schemas import MONEY_TOTAL


def _kpi_aggs():
    alert = F.coalesce(F.col("fraud_alert"), F.lit(False))
    return [
        F.count("transaction_id").alias("txn_volume"),
        F.sum("amount").cast(MONEY_TOTAL).alias("txn_amount_total"),
        F.count_if(alert).alias("flagged_txn_count"),
        F.coalesce(F.sum(F.when(alert, F.col("amount"))), F.lit(0)).cast(MONEY_TOTAL)
        .alias("flagged_exposure_amount"),
    ]


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("fraud_rate_pct", round_ratio(
        F.col("flagged_txn_count"), F.col("txn_volume"), 3, factor=100))


def daily_kpis(gold: DataFrame) -> DataFrame:
    """Per (txn_date, region, channel)."""
    return _with_rate(gold.groupBy("txn_date", "region", "channel").agg(*_kpi_aggs()))


def hourly_kpis(gold: DataFrame) -> DataFrame:
    """Per (hour of event time, region, channel)."""
    g = gold.withColumn("txn_hour", F.date_trunc("hour", F.col("transaction_ts")).cast("timestamp_ntz"))
    return _with_rate(g.groupBy("txn_hour", "region", "channel").agg(*_kpi_aggs()))


def _day_range(df: DataFrame, as_of: dt.date, days: int) -> DataFrame:
    return df.filter((F.col("txn_date") >= F.lit(days_before(as_of, days)))
                     & (F.col("txn_date") <= F.lit(as_of)))


def fraud_trend(gold: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """K1: daily fraud rate by region over ``days + 1`` days up to ``as_of``."""
    alert = F.coalesce(F.col("fraud_alert"), F.lit(False))
    g = _day_range(gold, as_of, days).groupBy("txn_date", "region").agg(
        F.count(F.lit(1)).alias("txn_volume"),
        F.count_if(alert).alias("flagged_txn_count"))
    return (g.withColumn("fraud_rate_pct", round_ratio(
        F.col("flagged_txn_count"), F.col("txn_volume"), 3, factor=100))
        .orderBy(F.col("txn_date").desc(), "region"))


def top_accounts(alerts: DataFrame, as_of: dt.date, days: int = 7, k: int = 25) -> DataFrame:
    """K2: top-k flagged accounts by exposure (ties by account id)."""
    a = _day_range(alerts, as_of, days).filter(F.col("fraud_alert"))
    g = a.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("flagged_txn_count"),
        F.sum("amount").cast(MONEY_TOTAL).alias("total_exposure_amount"),
        F.max(F.col("fraud_risk_score").cast("double")).alias("max_risk_score"))
    return g.orderBy(F.col("total_exposure_amount").desc(), "account_id").limit(k)


def geo_exposure(alerts: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """K3: flagged volume by country joined to the geo dimension."""
    geo = bounded_broadcast(dedup_dim(dim_geo.select("country_code", "country_name", "fatf_watchlist"), "country_code"),
                            DIM_BROADCAST_MAX_BYTES)
    a = alerts.filter(F.col("fraud_alert")).join(geo, "country_code")
    g = a.groupBy("country_code", "country_name", "fatf_watchlist").agg(
        F.count(F.lit(1)).alias("flagged_txn_count"),
        F.sum("amount").cast(MONEY_TOTAL).alias("flagged_amount_total"))
    return g.orderBy(F.col("flagged_amount_total").desc(), "country_code")


def channel_breakdown(gold: DataFrame, as_of: dt.date) -> DataFrame:
    """K4: yesterday's volume, flagged count and average score per channel."""
    day = days_before(as_of, 1)
    alert = F.coalesce(F.col("fraud_alert"), F.lit(False))
    s, n = avg_of_scaled(F.col("fraud_risk_score"), 4)
    g = gold.filter(F.col("txn_date") == F.lit(day)).groupBy("channel").agg(
        F.count(F.lit(1)).alias("txn_volume"),
        F.count_if(alert).alias("flagged_count"),
        s.alias("_s"), n.alias("_n"))
    g = g.withColumn("avg_risk_score", round_ratio(F.col("_s"), F.col("_n") * 10000, 4)).drop("_s", "_n")
    return g.orderBy(F.col("flagged_count").desc(), "channel")


def discrepancy_audit(disc: DataFrame, as_of: dt.date, days: int = 1) -> DataFrame:
    """K5: unresolved discrepancies of the last ``days`` days by type."""
    d = _day_range(disc, as_of, days).filter(~F.coalesce(F.col("resolved"), F.lit(False)))
    var = F.abs(F.coalesce(F.col("stream_amount"), F.lit(0)) - F.coalesce(F.col("batch_amount"), F.lit(0)))
    g = d.groupBy("discrepancy_type").agg(
        F.count(F.lit(1)).alias("discrepancy_count"),
        F.sum(var).cast(MONEY_TOTAL).alias("total_variance_amount"))
    return g.orderBy(F.col("discrepancy_count").desc(), "discrepancy_type")


def recon_accuracy(gold: DataFrame, disc: DataFrame, as_of: dt.date) -> DataFrame:
    """K6: yesterday's accuracy; the denominator is all transactions of the day.

    Both counts come from one aggregation over a tagged union of the two
    day slices (no join of the scalar results).
    """
    day = days_before(as_of, 1)
    t = gold.filter(F.col("txn_date") == F.lit(day)).select(F.lit(True).alias("_gold"))
    m = disc.filter(F.col("txn_date") == F.lit(day)).select(F.lit(False).alias("_gold"))
    j = t.unionByName(m).agg(F.count_if(F.col("_gold")).alias("total_txns"),
                             F.count_if(~F.col("_gold")).alias("mismatch_count"))
    return j.withColumn("reconciliation_accuracy_pct", round_ratio(
        F.col("total_txns") - F.col("mismatch_count"), F.col("total_txns"), 2, factor=100))


def high_risk_mcc(gold: DataFrame, as_of: dt.date, days: int = 1, min_count: int = 3) -> DataFrame:
    """K7: high-risk MCC groups per (account, mcc) with more than ``min_count`` rows.

    ``days`` = 1 is yesterday only (the report's definition); longer
    look-backs end yesterday as well.
    """
    day = days_before(as_of, 1)
    g = gold.filter(F.col("high_risk_mcc_flag")
                    & (F.col("txn_date") >= F.lit(days_before(day, days - 1)))
                    & (F.col("txn_date") <= F.lit(day)))
    a = g.groupBy("account_id", "mcc_code").agg(
        F.count(F.lit(1)).alias("txn_count"),
        F.sum("amount").cast(MONEY_TOTAL).alias("total_amount"),
        F.bool_or(F.coalesce(F.col("velocity_flag"), F.lit(False))).alias("any_velocity_flag"))
    return a.filter(F.col("txn_count") > min_count).orderBy(F.col("total_amount").desc(), "account_id", "mcc_code")
