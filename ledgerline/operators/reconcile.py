"""Stream-versus-batch reconciliation (full outer join on the key)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio
from ledgerline.operators.quality import dedup_latest
from ledgerline.params import RECON_TOLERANCE
from ledgerline.functions.timefn import ts_literal

# Fixed discrepancy labels.
MATCH = "MATCH"
AMOUNT_MISMATCH = "AMOUNT_MISMATCH"
MISSING_IN_BATCH = "MISSING_IN_BATCH"
MISSING_IN_STREAM = "MISSING_IN_STREAM"


def _side(df: DataFrame, tag: str) -> DataFrame:
    """Non-null keys, one row per key (latest version).

    Inputs are normally unique per key already; the dedup is a guard that
    costs no extra exchange (the join reuses its hash partitioning on the
    key) and, pre-limited on the map side, keeps a mass of copies of one key
    away from a single reducer, which a full outer join could not split.
    """
    order = [c for c in ("updated_at", "ingest_ts") if c in df.columns]
    # narrow first: the tie break of the dedup hashes every column that is left
    df = df.select("transaction_id", "amount", "transaction_ts", *order)
    df = dedup_latest(df.filter(F.col("transaction_id").isNotNull()), ("transaction_id",), order)
    return df.select(
        "transaction_id",
        F.col("amount").alias(f"{tag}_amount"),
        F.to_date("transaction_ts").alias(f"_{tag}_date"),
        F.lit(True).alias(f"_in_{tag}"))


def reconcile(stream: DataFrame, batch: DataFrame, tolerance: str = RECON_TOLERANCE) -> DataFrame:
    """One row per key of either side with its ``discrepancy_type`` (or MATCH).

    Null keys never match anything and are expected to be quarantined
    upstream; they are excluded here.  Columns are renamed before the join
    so nothing is ambiguous, and presence markers decide which side is
    missing.  Physical plan: one shuffle per side (shared by the per-key
    dedup and the join), sort-merge full outer.
    """
    s, b = _side(stream, "stream"), _side(batch, "batch")
    j = s.join(b, "transaction_id", "full_outer")
    diff = F.abs(F.coalesce(F.col("stream_amount"), F.lit(0))
                 - F.coalesce(F.col("batch_amount"), F.lit(0)))
    kind = (F.when(F.col("_in_stream").isNull(), F.lit(MISSING_IN_STREAM))
            .when(F.col("_in_batch").isNull(), F.lit(MISSING_IN_BATCH))
            .when(diff > F.lit(Decimal(tolerance)), F.lit(AMOUNT_MISMATCH))
            .otherwise(F.lit(MATCH)))
    return j.select(
        "transaction_id", kind.alias("discrepancy_type"), "stream_amount", "batch_amount",
        F.coalesce(F.col("_stream_date"), F.col("_batch_date")).alias("txn_date"))


def discrepancies(rec: DataFrame, detected_at: dt.datetime) -> DataFrame:
    """Non-matching rows in the serving-table shape (resolved defaults to false)."""
    return rec.filter(F.col("discrepancy_type") != MATCH).select(
        "transaction_id", "discrepancy_type", "stream_amount", "batch_amount", "txn_date",
        ts_literal(detected_at).alias("detected_at"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast("string").alias("resolution_notes"))


def recon_summary(rec: DataFrame) -> DataFrame:
    """Counts by type, key match rate and exact accuracy (2 dp), one pass."""
    t = F.col("discrepancy_type")
    g = rec.agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(t.isin(MATCH, AMOUNT_MISMATCH)).alias("matched_count"),
        F.count_if(t == MATCH).alias("exact_match_count"),
        F.count_if(t == AMOUNT_MISMATCH).alias("amount_mismatch_count"),
        F.count_if(t == MISSING_IN_BATCH).alias("missing_in_batch_count"),
        F.count_if(t == MISSING_IN_STREAM).alias("missing_in_stream_count"))
    return g.select(
        "*",
        F.coalesce(round_ratio(F.col("matched_count"), F.col("total_count"), 2, factor=100),
                   F.lit(0.0)).alias("match_rate_pct"),
        F.coalesce(round_ratio(F.col("exact_match_count"), F.col("total_count"), 2, factor=100),
                   F.lit(0.0)).alias("accuracy_pct"))
