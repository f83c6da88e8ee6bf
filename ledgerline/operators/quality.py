"""Silver data quality: rule flags, clean/reject split, dedup, gate metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio
from ledgerline.functions.quality import dq_flags
from ledgerline.params import DqParams


def with_dq_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("dq_flags", dq_flags())


def split_clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) by the size of ``dq_flags``; together they are the input."""
    flagged = df if "dq_flags" in df.columns else with_dq_flags(df)
    n = F.size("dq_flags")
    return flagged.filter(n == 0), flagged.filter(n > 0)


def dedup_latest(df: DataFrame, keys: Sequence[str] = ("transaction_id",),
                 order_cols: Sequence[str] = ("ingest_ts", "updated_at")) -> DataFrame:
    """Keep the latest version per key.

    Ties on ``order_cols`` are broken by a hash of the whole row, so the
    result is a function of the input set, not of task order.  The
    ``row_number() == 1`` shape lets the planner put a partial
    ``WindowGroupLimit`` before the shuffle: each map task forwards at most
    one row per key, so a key with a huge number of copies never reaches one
    reducer whole.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    order = [F.col(c).desc_nulls_last() for c in order_cols] + [tie.desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def orphan_accounts(df: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Rows whose account is unknown to the account dimension (anti join)."""
    known = dim_account.select("account_id").distinct()
    return df.filter(F.col("account_id").isNotNull()).join(known, "account_id", "left_anti")


def dq_gate(gold: DataFrame, rec: DataFrame, day: dt.date,
            params: DqParams = DqParams()) -> DataFrame:
    """One decision row for ``day``: metrics plus one boolean per threshold.

    ``rec`` is the reconciliation of the run (one row per key with its
    ``discrepancy_type``); all of its keys count, whatever their day.  All
    metrics come from a single aggregation over a tagged union of the two inputs.
    """
    g = gold.filter(F.col("txn_date") == F.lit(day)).select(
        F.lit("g").alias("_src"), F.col("transaction_id").isNull().alias("_null_id"),
        F.lit(False).alias("_match"))
    r = rec.select(F.lit("r").alias("_src"), F.lit(False).alias("_null_id"),
                   (F.col("discrepancy_type") == "MATCH").alias("_match"))
    src = F.col("_src")
    m = g.unionByName(r).agg(
        F.count_if(src == "g").alias("row_count"),
        F.count_if((src == "g") & F.col("_null_id")).alias("null_ids"),
        F.count_if(src == "r").alias("_rec_total"),
        F.count_if((src == "r") & F.col("_match")).alias("_rec_match"))
    out = m.select(
        F.lit(day).alias("gate_date"),
        "row_count", "null_ids",
        round_ratio(F.col("null_ids"), F.col("row_count"), 3, factor=100).alias("null_rate_pct"),
        F.coalesce(round_ratio(F.col("_rec_match"), F.col("_rec_total"), 2, factor=100),
                   F.lit(0.0)).alias("recon_accuracy_pct"),
    )
    out = out.select(
        "*",
        (F.col("row_count") >= params.min_daily_rows).alias("rows_ok"),
        F.coalesce(F.col("null_rate_pct") <= params.max_null_rate_pct, F.lit(False)).alias("nulls_ok"),
        F.coalesce(F.col("recon_accuracy_pct") >= params.recon_target_pct, F.lit(False)).alias("recon_ok"),
    )
    return out.withColumn("passed", F.col("rows_ok") & F.col("nulls_ok") & F.col("recon_ok"))
