"""End-to-end Bronze -> Silver -> Gold plans composed from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators import enrich as en
from ledgerline.operators import ingest, quality, scoring
from ledgerline.operators import kpis as _kpis
from ledgerline.operators.incremental import upsert as _upsert
from ledgerline.plans import marts, serving
from ledgerline.operators.velocity import CELL, LONG_WINDOW_S, default_cell, trailing_rows, velocity_columns, velocity_signals
from ledgerline.params import RiskParams
from ledgerline.sinks.writers import drop_stale, replace_days
from ledgerline.sinks.writers import write_partitioned as _write


def silver(bronze: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame,
           params: RiskParams = RiskParams()) -> tuple[DataFrame, DataFrame]:
    """Quality rules -> dedup -> enrichment -> velocity; returns (silver, rejected)."""
    clean, rejected = quality.split_clean(bronze)
    deduped = quality.dedup_latest(clean)
    enriched = en.enrich(deduped, dim_mcc, dim_geo, params)
    if params.velocity_window_s > LONG_WINDOW_S:
        return velocity_signals(enriched, params), rejected
    rows = trailing_rows(enriched, params.velocity_window_s)
    return velocity_columns(rows.drop(CELL), params), rejected


def score_transactions(df: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame,
                       params: RiskParams = RiskParams()) -> DataFrame:
    """Velocity, enrichment, outlier and score for event rows in one pass.

    The rows are shuffled once, by (account, cell): the rolling window runs there
    and the account statistics, spread over the same cells, join without a
    further shuffle of rows.  The dimensions are broadcast after a size check.
    """
    cell_s = default_cell(params.velocity_window_s)
    acct = scoring.spread_stats(df, cell_s).withColumnsRenamed({"n_amt": "a_n", "s_amt": "a_s", "s_sq": "a_sq"})
    rows = velocity_columns(trailing_rows(df, params.velocity_window_s, cell_s=cell_s), params)
    rows = rows.join(acct, (F.col("account_id") == F.col("_a")) & (F.col(CELL) == F.col("_c")), "left").drop("_a", "_c", CELL)
    rows = rows.withColumn("amount_outlier_flag", scoring.outlier_test(
        F.col("amount"), F.coalesce(F.col("a_n"), F.lit(0)), F.col("a_s"), F.col("a_sq"), params.zscore))
    rows = rows.drop("a_n", "a_s", "a_sq")
    rows = en.enrich(rows, dim_mcc, dim_geo, params)
    return scoring.risk_score(rows, params)


def gold_from_events(txn: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame, salt: str,
                     params: RiskParams = RiskParams()) -> DataFrame:
    """Clean event rows -> Gold projection (ingest date = event date here)."""
    scored = score_transactions(txn, dim_mcc, dim_geo, params)
    scored = ingest.tokenize_pan(scored, salt)
    if "ingest_date" not in scored.columns:
        scored = scored.withColumn("ingest_date", F.to_date("transaction_ts"))
    return scoring.gold_transactions(scored)


def gold_from_silver(silver_df: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Gold job on a Silver table that already carries velocity and enrichment."""
    return scoring.gold_transactions(
        scoring.risk_score(scoring.amount_outliers(silver_df, params), params))


def fraud_alerts(gold: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """P15 + serving contract: alert rows in the table's shape, score as
    decimal(6,4); a NULL in a NOT NULL column fails the load."""
    return serving.shaped(gold.filter(F.col("fraud_alert")), "fraud_alerts", loaded_at)


# --- jobs: the same plans with their sinks -------------------------------------


def run_bronze(spark: SparkSession, raw: DataFrame, bronze_path: str, salt: str,
               ingest_ts: dt.datetime | None = None, batch_id: str | None = None,
               source_file: str | None = None) -> dict[str, int]:
    """Bronze job: tokenised rows partitioned by (ingest_date, region) plus
    quarantine; counts come from ``observe`` on the writes (no extra pass).

    Each batch lands in its own ``batch_id`` sub-partition written with a
    dynamic overwrite, so re-running a batch after a failure replaces its
    own files instead of appending duplicates, while readers still prune
    on (ingest_date, region).
    """
    valid, quarantine = ingest.ingest_bronze(raw, salt, ingest_ts, batch_id, source_file)
    ov, oq = Observation("bronze"), Observation("quarantine")
    _write(valid.observe(ov, F.count(F.lit(1)).alias("rows")), bronze_path,
           ["ingest_date", "region", "batch_id"], mode="overwrite")
    _write(quarantine.observe(oq, F.count(F.lit(1)).alias("rows")),
           bronze_path.rstrip("/") + "_quarantine", ["batch_id"], mode="overwrite", cluster=False)
    return {"bronze_rows": ov.get["rows"], "quarantined": oq.get["rows"]}


def run_silver(spark: SparkSession, bronze_df: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame,
               silver_path: str, exists: bool, params: RiskParams = RiskParams()) -> dict[str, int]:
    """Silver job: idempotent upsert by transaction_id (replays do not
    duplicate history); the rejected rows of a batch replace its earlier ones.
    Accepted and rejected rows are counted on the rejects' own write."""
    seen, bad = Observation("quality"), F.size("dq_flags") > 0
    flagged = quality.with_dq_flags(bronze_df)
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rejected"))
    _write(counted.filter(bad), silver_path.rstrip("/") + "_rejected", ["batch_id"], mode="overwrite", cluster=False)
    silver_df, _ = silver(bronze_df, dim_mcc, dim_geo, params)
    # Silver keeps the latest version of each id: the upsert need not look for it again
    n = _upsert(spark, silver_path, silver_df, "ingest_date", order_col="ingest_ts", exists=exists, unique=True)
    got = seen.get
    return {"silver_rows_published": n, "rejected": got["rejected"], "accepted": got["rows"] - got["rejected"]}


def run_gold(spark: SparkSession, silver_df: DataFrame, gold_path: str, kpi_path: str,
             alerts_path: str, loaded_at: dt.datetime, params: RiskParams = RiskParams(),
             marts_path: str | None = None) -> dict[str, int]:
    """Gold job: score once, write Gold partitioned by (txn_date, region),
    then derive KPIs, alerts and the report marts from the written table (the
    scoring plan is not re-run for each sink).  All partitions of the processed
    days are replaced in all of them, also by nothing.  Rows without a
    timestamp belong to no day: they stay in Gold, are counted as ``undated``
    and reach no roll-up."""
    og = Observation("gold")
    g = gold_from_silver(silver_df, params)
    _write(g.observe(og, F.count(F.lit(1)).alias("rows"), F.count_if("fraud_alert").alias("alerts"),
                     F.count_if(F.col("txn_date").isNull()).alias("undated")),
           gold_path, ["txn_date", "region"], mode="overwrite")
    keys = silver_df.select(F.to_date("transaction_ts").alias("txn_date"), "region").distinct()
    days = sorted({r["txn_date"] for r in keys.collect() if r["txn_date"] is not None})
    drop_stale(spark, keys, gold_path, ["txn_date", "region"], days)
    publish_days(spark, g.schema, gold_path, kpi_path, alerts_path, loaded_at, days, marts_path)
    return {"gold_rows": og.get["rows"], "alerts": og.get["alerts"], "undated": og.get["undated"]}


def publish_days(spark: SparkSession, gold_schema: T.StructType, gold_path: str, kpi_path: str, alerts_path: str,
                 loaded_at: dt.datetime, days: Sequence[dt.date], marts_path: str | None = None) -> None:
    """Replace ``days`` of the tables derived from stored Gold: KPIs, alerts, marts.

    Gold is read in its own types: directory names alone would turn a region
    "01" into 1."""
    gold = spark.read.schema(gold_schema).parquet(gold_path)
    written = gold.where(F.col("txn_date").isin(list(days)))
    replace_days(spark, _kpis.daily_kpis(written), kpi_path, ["txn_date"], days)
    replace_days(spark, fraud_alerts(written, loaded_at), alerts_path, ["txn_date"], days)
    if marts_path:
        alerts = spark.read.schema(schemas.FRAUD_ALERTS).parquet(alerts_path)
        marts.refresh(spark, marts_path, days, gold=gold, alerts=alerts)


def run_batch_transform(spark: SparkSession, src_path: str, out_path: str) -> int:
    """Schema-merging scan -> batch features -> overwrite by txn_date."""
    from ledgerline.operators.features import batch_features
    from ledgerline.sources.scans import scan_merge_schema
    o = Observation("features")
    df = batch_features(scan_merge_schema(spark, src_path))
    _write(df.observe(o, F.count(F.lit(1)).alias("rows")), out_path, ["txn_date"], mode="overwrite")
    return o.get["rows"]


def run_reconcile(spark: SparkSession, stream_df: DataFrame, batch_df: DataFrame, out_path: str,
                  detected_at: dt.datetime, marts_path: str | None = None) -> dict[str, int]:
    """B8 + G6: discrepancies (serving shape) by txn_date and run; a replay of a
    run replaces its own rows.  The summary counts are observed on the same
    pass as the write.  With ``marts_path`` the days that the run touched are
    replaced in the report mart, from its own rows."""
    from ledgerline.operators import reconcile as rc
    rec = rc.reconcile(stream_df, batch_df)
    t = F.col("discrepancy_type")
    o = Observation("recon")
    rec = rec.observe(o, F.count(F.lit(1)).alias("total_count"),
                      F.count_if(t.isin(rc.MATCH, rc.AMOUNT_MISMATCH)).alias("matched_count"),
                      F.count_if(t == rc.MATCH).alias("exact_match_count"))
    run_id = detected_at.strftime("%Y%m%d%H%M%S")
    found = serving.shaped(rc.discrepancies(rec, detected_at), "reconciliation_discrepancies", detected_at).withColumn("run_id", F.lit(run_id))
    _write(found, out_path, ["txn_date", "run_id"], mode="overwrite")
    if marts_path:
        mine = spark.read.schema(found.schema).parquet(out_path).where(F.col("run_id") == run_id)
        days = [r[0] for r in mine.select("txn_date").distinct().collect() if r[0] is not None]  # partition values
        marts.refresh(spark, marts_path, days, disc=mine)
    return dict(o.get)
