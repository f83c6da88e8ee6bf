"""Dimension enrichment and account-level signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.params import DIM_BROADCAST_MAX_BYTES, RiskParams
from ledgerline.runtime import bounded_broadcast


def dedup_dim(dim: DataFrame, key: str) -> DataFrame:
    """One row per key (declared keys are not enforced upstream)."""
    others = [F.col(c).asc_nulls_last() for c in dim.columns if c != key]
    w = Window.partitionBy(key).orderBy(*others) if others else Window.partitionBy(key).orderBy(key)
    return dim.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def enrich(df: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame,
           params: RiskParams = RiskParams(),
           max_dim_bytes: int = DIM_BROADCAST_MAX_BYTES) -> DataFrame:
    """Left-join merchant and geo dimensions, add the MCC flag and geo score.

    Both dimensions are deduplicated on their key and broadcast only after
    their size is checked, so the fact side is never shuffled here.
    """
    mcc = bounded_broadcast(dedup_dim(dim_mcc, "mcc_code"), max_dim_bytes)
    geo = bounded_broadcast(dedup_dim(dim_geo, "country_code"), max_dim_bytes)
    out = df.join(mcc, "mcc_code", "left").join(geo, "country_code", "left")
    return (out
            .withColumn("high_risk_mcc_flag",
                        F.coalesce(F.col("mcc_code").isin(list(params.high_risk_mcc)), F.lit(False)))
            .withColumn("geo_risk_score",
                        F.coalesce(F.col("geo_risk_score").cast("double"), F.lit(0.0))))


def geo_mismatch(df: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Flag rows whose country differs from the account's home country.

    The account dimension grows with the customer base, so this is a plain
    equi-join (sort-merge or AQE-converted broadcast), not a forced broadcast.
    Rows without an account match nothing; a second join key spreads them
    over all tasks instead of sending them to the one that NULL hashes to.
    """
    acct = dedup_dim(dim_account.select("account_id", F.col("home_country").alias("_home")), "account_id")
    acct = acct.select("account_id", "_home", F.lit(0).cast("long").alias("_spread"))
    spread = F.when(F.col("account_id").isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0))
    out = df.withColumn("_spread", spread).join(acct, ["account_id", "_spread"], "left").drop("_spread")
    return (out.withColumn("geo_mismatch_flag",
                           F.coalesce(F.col("country_code") != F.col("_home"), F.lit(False)))
            .withColumnRenamed("_home", "account_home_country"))
