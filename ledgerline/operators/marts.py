"""Mergeable partial aggregates of Gold, alerts and discrepancies, and the reports on them.

Each mart holds counts, exact sums and maxima per day and the columns that reports
group by, so that a report adds up stored partials instead of reading events, and a
corrected day is simply replaced (``plans.marts``).  The reports equal those of
``operators.kpis`` on the rows themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import avg_of_scaled, round_ratio
from ledgerline.functions.timefn import days_before
from ledgerline.operators.enrich import dedup_dim
from ledgerline.operators.kpis import _day_range
from ledgerline.params import DIM_BROADCAST_MAX_BYTES
from ledgerline.runtime import bounded_broadcast
from ledgerline.schemas import MONEY_TOTAL

def _alert():
    return F.coalesce(F.col("fraud_alert"), F.lit(False))


def totals(gold: DataFrame) -> DataFrame:
    """(day, region, channel): rows, flagged rows, sum and number of scores in 1/10000."""
    s, n = avg_of_scaled(F.col("fraud_risk_score"), 4)
    return gold.groupBy("txn_date", "region", "channel").agg(
        F.count(F.lit(1)).alias("txn_count"), F.count_if(_alert()).alias("flagged_count"), s.alias("score_sum"), n.alias("score_count"))


def alerted(alerts: DataFrame) -> DataFrame:
    """(day, account, country): flagged rows, their amount and highest score."""
    return alerts.filter("fraud_alert").groupBy("txn_date", "account_id", "country_code").agg(
        F.count(F.lit(1)).alias("flagged_count"), F.sum("amount").cast(MONEY_TOTAL).alias("amount"),
        F.max(F.col("fraud_risk_score").cast("double")).alias("max_score"))


def risky(gold: DataFrame) -> DataFrame:
    """(day, account, merchant code) of the high-risk codes: rows, amount, any velocity flag."""
    return gold.filter("high_risk_mcc_flag").groupBy("txn_date", "account_id", "mcc_code").agg(
        F.count(F.lit(1)).alias("txn_count"), F.sum("amount").cast(MONEY_TOTAL).alias("amount"),
        F.bool_or(F.coalesce(F.col("velocity_flag"), F.lit(False))).alias("any_velocity"))


def discrepant(disc: DataFrame) -> DataFrame:
    """(day, type, resolved): rows and their variance."""
    var = F.abs(F.coalesce(F.col("stream_amount"), F.lit(0)) - F.coalesce(F.col("batch_amount"), F.lit(0)))
    return disc.groupBy("txn_date", "discrepancy_type", F.coalesce(F.col("resolved"), F.lit(False)).alias("resolved")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(var).cast(MONEY_TOTAL).alias("variance"))


# ---- reports ------------------------------------------------------------------------

def fraud_trend(t: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """K1 from ``totals``."""
    g = _day_range(t, as_of, days).groupBy("txn_date", "region").agg(
        F.sum("txn_count").alias("txn_volume"), F.sum("flagged_count").alias("flagged_txn_count"))
    rate = round_ratio(F.col("flagged_txn_count"), F.col("txn_volume"), 3, factor=100)
    return g.withColumn("fraud_rate_pct", rate).orderBy(F.col("txn_date").desc(), "region")


def top_accounts(a: DataFrame, as_of: dt.date, days: int = 7, k: int = 25) -> DataFrame:
    """K2 from ``alerted``."""
    g = _day_range(a, as_of, days).groupBy("account_id").agg(
        F.sum("flagged_count").alias("flagged_txn_count"), F.sum("amount").cast(MONEY_TOTAL).alias("total_exposure_amount"),
        F.max("max_score").alias("max_risk_score"))
    return g.orderBy(F.col("total_exposure_amount").desc(), "account_id").limit(k)


def geo_exposure(a: DataFrame, dim_geo: DataFrame) -> DataFrame:
    """K3 from ``alerted``."""
    geo = bounded_broadcast(dedup_dim(dim_geo.select("country_code", "country_name", "fatf_watchlist"), "country_code"), DIM_BROADCAST_MAX_BYTES)
    by_country = a.groupBy("country_code").agg(F.sum("flagged_count").alias("n"), F.sum("amount").alias("s"))
    return (by_country.join(geo, "country_code")
            .select("country_code", "country_name", "fatf_watchlist", F.col("n").alias("flagged_txn_count"), F.col("s").cast(MONEY_TOTAL).alias("flagged_amount_total"))
            .orderBy(F.col("flagged_amount_total").desc(), "country_code"))


def channel_breakdown(t: DataFrame, as_of: dt.date) -> DataFrame:
    """K4 from ``totals``."""
    g = t.filter(F.col("txn_date") == F.lit(days_before(as_of, 1))).groupBy("channel").agg(
        F.sum("txn_count").alias("txn_volume"), F.sum("flagged_count").alias("flagged_count"), F.sum("score_sum").alias("_s"), F.sum("score_count").alias("_n"))
    g = g.withColumn("avg_risk_score", round_ratio(F.col("_s"), F.col("_n") * 10000, 4)).drop("_s", "_n")
    return g.orderBy(F.col("flagged_count").desc(), "channel")


def discrepancy_audit(d: DataFrame, as_of: dt.date, days: int = 1) -> DataFrame:
    """K5 from ``discrepant``."""
    g = _day_range(d, as_of, days).filter(~F.col("resolved")).groupBy("discrepancy_type").agg(
        F.sum("row_count").alias("discrepancy_count"), F.sum("variance").cast(MONEY_TOTAL).alias("total_variance_amount"))
    return g.orderBy(F.col("discrepancy_count").desc(), "discrepancy_type")


def recon_accuracy(t: DataFrame, d: DataFrame, as_of: dt.date) -> DataFrame:
    """K6 from ``totals`` and ``discrepant``; one row, also of days without any."""
    day = F.col("txn_date") == F.lit(days_before(as_of, 1))
    both = (t.filter(day).select(F.col("txn_count").alias("n"), F.lit(0).cast("long").alias("m"))
            .union(d.filter(day).select(F.lit(0).cast("long"), "row_count")))
    j = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_txns"), F.coalesce(F.sum("m"), F.lit(0)).alias("mismatch_count"))
    return j.withColumn("reconciliation_accuracy_pct", round_ratio(
        F.col("total_txns") - F.col("mismatch_count"), F.col("total_txns"), 2, factor=100))


def high_risk_mcc(r: DataFrame, as_of: dt.date, days: int = 1, min_count: int = 3) -> DataFrame:
    """K7 from ``risky``."""
    last = days_before(as_of, 1)
    g = r.filter((F.col("txn_date") >= F.lit(days_before(last, days - 1))) & (F.col("txn_date") <= F.lit(last)))
    a = g.groupBy("account_id", "mcc_code").agg(
        F.sum("txn_count").alias("txn_count"), F.sum("amount").cast(MONEY_TOTAL).alias("total_amount"), F.bool_or("any_velocity").alias("any_velocity_flag"))
    return a.filter(F.col("txn_count") > min_count).orderBy(F.col("total_amount").desc(), "account_id", "mcc_code")
