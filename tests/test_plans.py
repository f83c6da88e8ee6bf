"""Physical-plan checks: no Python in batch plans, pushdown, broadcast, skew-safe shapes."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from small_tables import SF_SMALL
from ledgerline.operators import incremental as inc
from ledgerline.operators import kpis, quality
from ledgerline.params import AS_OF
from ledgerline.plans.registry import REGISTRY, gold
from ledgerline.sinks import writers
from ledgerline.sources import fixtures as fx
from ledgerline.sources import scans

# queries that write first and return the read-back table are planned as scans
WRITING = {"scan_json_raw", "sink_partitioned_roundtrip", "scan_partitioned", "scan_merge_schema",
           "incremental_run", "incremental_ledger", "compacted_table", "run_metrics", "schema_evolving_append",
           "stream_dedup", "stream_windowed_kpis", "stream_velocity", "stream_late_arrivals", "stream_batch_metrics"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_no_python_in_batch_plans(spark, name):
    p = plan(REGISTRY[name](spark, SF_SMALL))
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_velocity_never_windows_by_account_alone(spark):
    p = plan(gold(spark, SF_SMALL))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", p)
    assert windows, p
    for parts in windows:
        assert parts.strip() not in ("account_id", ) and not re.fullmatch(r"account_id#\d+", parts.strip())
    assert "BroadcastHashJoin" in p


def test_dedup_is_pre_limited_before_the_shuffle(spark):
    b = quality.split_clean(fx.txn_raw(spark, SF_SMALL).withColumnRenamed("card_number", "card_number_token"))[0]
    p = plan(quality.dedup_latest(b))
    part = p.find("WindowGroupLimit")
    assert "Partial" in p and part >= 0
    # the partial limit sits below (after, in text) the exchange
    assert p.rfind("WindowGroupLimit") > p.find("Exchange hashpartitioning(transaction_id")


def test_report_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    writers.write_partitioned(gold(spark, SF_SMALL), path, ["txn_date", "region"], mode="overwrite")
    g = scans.scan_partitioned(spark, path)
    p = plan(kpis.fraud_trend(g, AS_OF, days=3))
    m = re.search(r"PartitionFilters: \[([^\]]*)\]", p)
    assert m and "txn_date" in m.group(1)
    p4 = plan(kpis.channel_breakdown(g, AS_OF))
    assert re.search(r"PartitionFilters: \[[^\]]*txn_date", p4)
    assert "ReadSchema: struct<channel:string,fraud_risk_score:double,fraud_alert:boolean>" in p4


def test_incremental_filter_is_pushed_down(spark, tmp_path):
    path = str(tmp_path / "extract")
    fx.batch(spark, SF_SMALL).write.parquet(path)
    ext = inc.extract_incremental(spark.read.parquet(path), dt.datetime(2024, 1, 20))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(updated_at", plan(ext))


def test_dimensions_are_broadcast(spark):
    p = plan(E.queries()["enrich_dims"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2


def test_reconcile_is_one_full_outer_join(spark):
    p = plan(E.queries()["recon_summary"](spark, SF_SMALL))
    assert len(re.findall(r"(SortMergeJoin|ShuffledHashJoin|BroadcastHashJoin) \[transaction_id", p)) == 1
    assert "FullOuter" in p


def test_bucketed_sides_reconcile_without_shuffle(spark, tmp_path):
    from ledgerline.operators import reconcile
    cols = ["transaction_id", "amount", "transaction_ts", "updated_at"]
    writers.write_bucketed(fx.txn(spark, SF_SMALL).select(*cols), "rec_stream", str(tmp_path / "s"),
                           "transaction_id", 8)
    writers.write_bucketed(fx.batch(spark, SF_SMALL).select(*cols), "rec_batch", str(tmp_path / "b"),
                           "transaction_id", 8)
    try:
        rec = reconcile.reconcile(spark.table("rec_stream"), spark.table("rec_batch"))
        p = plan(rec)
        assert "FullOuter" in p and "Exchange hashpartitioning" not in p
        got = {r[0]: r[1] for r in rec.groupBy("discrepancy_type").count().collect()}
        assert got == {"MATCH": 965, "AMOUNT_MISMATCH": 16, "MISSING_IN_BATCH": 19, "MISSING_IN_STREAM": 15}
    finally:
        spark.sql("DROP TABLE IF EXISTS rec_stream")
        spark.sql("DROP TABLE IF EXISTS rec_batch")


KPI_KEYS = sorted(k for k in REGISTRY if k.startswith("kpi_"))


@pytest.mark.parametrize("name", KPI_KEYS)
def test_reports_scan_stored_marts_and_no_events(spark, name):
    df = REGISTRY[name](spark, SF_SMALL)
    assert len(KPI_KEYS) == 8 and not any(SF_SMALL in f for f in df.inputFiles())
    assert all("/marts/" in f for f in df.inputFiles())


def test_timestamps_are_matched_once(spark):
    from ledgerline.plans.registry import envelopes
    from ledgerline.streaming import envelope as envl
    for df, n in ((envl.decode_envelope(envelopes(spark, SF_SMALL)), 2), (envl.route(envl.decode_envelope(envelopes(spark, SF_SMALL)))[0], 2)):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        assert p.count("RLIKE") == n and "regexp_extract(" not in p, p.count("RLIKE")


def test_dimension_broadcast_runs_no_job_and_is_bounded_by_bytes(spark):
    from ledgerline.runtime import bounded_broadcast
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    big = spark.range(10_000_000)
    assert "broadcast" in bounded_broadcast(spark.range(10), 1 << 20)._jdf.queryExecution().logical().toString().lower()
    assert bounded_broadcast(big, 1 << 20) is big
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == seen


def test_rows_without_an_account_are_spread(spark):
    from ledgerline.operators import enrich, scoring
    rows = fx.txn(spark, SF_SMALL).withColumn("account_id", F.when(F.col("event_id") % 3 > 0, F.col("account_id")))
    out = enrich.geo_mismatch(rows, fx.dim_account(spark, SF_SMALL))
    assert out.count() == 1000 and out.filter("account_id IS NULL AND (geo_mismatch_flag OR account_home_country IS NOT NULL)").count() == 0
    text = scoring.amount_outliers(rows)._jdf.queryExecution().executedPlan().toString()
    joined = [line for line in text.splitlines() if "Join" in line and "LeftOuter" in line]
    assert joined and all("_cell" in line for line in joined)
