"""Named queries over the test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables (through the derived fixtures) and
runs one operator or report end to end; ``ledgerline.oracle`` holds the
matching SQL.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import pan
from ledgerline.functions.timefn import days_before, ts_literal
from ledgerline.operators import contract as ct
from ledgerline.operators import enrich as en
from ledgerline.operators import features, ingest, kpis, marts, quality, reconcile, scoring
from ledgerline.operators import incremental as inc
from ledgerline.operators.velocity import velocity_signals
from ledgerline.params import AS_OF, TEST_SALT, RiskParams
from ledgerline.plans import incremental_job as incremental_job_plan
from ledgerline.plans import marts as stored_marts
from ledgerline.plans import medallion, metrics, serving
from ledgerline.runtime import scratch_path
from ledgerline.schemas import RAW_EVENT, WATERMARKS
from ledgerline.sinks import compaction, evolving, writers
from ledgerline.sources import fixtures as fx
from ledgerline.sources import scans
from ledgerline.sources.tables import literal_table, table
from ledgerline.streaming import envelope as envl
from ledgerline.streaming import jobs as stream_jobs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
RUN_TS = dt.datetime(2024, 1, 31, 2, 0, 0)


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _dims(spark: SparkSession):
    return fx.dim_merchant_category(spark), fx.dim_geo_risk(spark)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    mcc, geo = _dims(spark)
    return medallion.gold_from_events(fx.txn(spark, sf_dir), mcc, geo, TEST_SALT)


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return medallion.fraud_alerts(gold(spark, sf_dir), RUN_TS)


def rec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.reconcile(fx.txn(spark, sf_dir), fx.batch(spark, sf_dir))


def disc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.discrepancies(rec(spark, sf_dir), RUN_TS)


# --- projections / protection -------------------------------------------
@query("tokenize_pan")
def q_tokenize_pan(spark, sf_dir):
    t = fx.txn(spark, sf_dir)
    return ingest.tokenize_pan(t, TEST_SALT).select("transaction_id", "card_number_token")


# --- rolling signals, enrichment, scoring -------------------------------
@query("velocity_signals")
def q_velocity(spark, sf_dir):
    return velocity_signals(fx.txn(spark, sf_dir))


@query("velocity_signals_bucketed")
def q_velocity_bucketed(spark, sf_dir):
    # finest split: cells as wide as the window (every row also copied as context)
    return velocity_signals(fx.txn(spark, sf_dir), cell_s=RiskParams().velocity_window_s)


@query("velocity_signals_day")
def q_velocity_day(spark, sf_dir):
    return velocity_signals(fx.txn(spark, sf_dir), RiskParams(velocity_window_s=86400))


@query("enrich_dims")
def q_enrich(spark, sf_dir):
    mcc, geo = _dims(spark)
    return en.enrich(fx.txn(spark, sf_dir), mcc, geo)


@query("account_stats")
def q_account_stats(spark, sf_dir):
    st = scoring.stats_columns(scoring.account_stats(fx.txn(spark, sf_dir)))
    return st.select("account_id", F.col("n_amt").alias("txn_count"), "avg_amount", "std_amount")


@query("amount_outliers")
def q_amount_outliers(spark, sf_dir):
    return scoring.amount_outliers(fx.txn(spark, sf_dir)).select(
        "transaction_id", "account_id", "amount", "avg_amount", "std_amount", "amount_outlier_flag")


@query("risk_score")
def q_risk_score(spark, sf_dir):
    mcc, geo = _dims(spark)
    return medallion.score_transactions(fx.txn(spark, sf_dir), mcc, geo)


@query("gold_transactions")
def q_gold(spark, sf_dir):
    return gold(spark, sf_dir)


@query("fraud_alerts")
def q_alerts(spark, sf_dir):
    return alerts(spark, sf_dir)


# --- KPIs and reports ---------------------------------------------------
@query("daily_fraud_kpis")
def q_daily(spark, sf_dir):
    return kpis.daily_kpis(gold(spark, sf_dir))


@query("hourly_fraud_kpis")
def q_hourly(spark, sf_dir):
    return kpis.hourly_kpis(gold(spark, sf_dir))


# --- reports on stored tables ---------------------------------------------
_STORED: dict[tuple, str] = {}


def _once(step):
    """Run a step that writes a folder once a session and table directory; returns the folder."""
    @functools.wraps(step)
    def run(spark, sf_dir) -> str:
        key = (step.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _STORED:
            root = scratch_path(spark, step.__name__.replace("_", "-"))
            step(spark, sf_dir, root)
            _STORED[key] = root
        return _STORED[key]
    return run


@_once
def stored_gold(spark, sf_dir, root):
    """Gold as the job writes it."""
    writers.write_partitioned(gold(spark, sf_dir), f"{root}/gold", ["txn_date", "region"], mode="overwrite")


@_once
def stored_reports(spark, sf_dir, root):
    """KPIs, alerts and the marts of stored Gold; the reports read the marts, no events are scored for them."""
    path, schema = f"{stored_gold(spark, sf_dir)}/gold", gold(spark, sf_dir).schema
    days = sorted(r[0] for r in scans.scan_partitioned(spark, path, schema).select("txn_date").distinct().collect() if r[0])
    medallion.publish_days(spark, schema, path, f"{root}/kpis", f"{root}/alerts", RUN_TS, days, f"{root}/marts")


@_once
def stored_discrepancies(spark, sf_dir, root):
    """Discrepancies and their mart: reconciliation asks for no Gold."""
    medallion.run_reconcile(spark, fx.txn(spark, sf_dir), fx.batch(spark, sf_dir), f"{root}/discrepancies", RUN_TS, f"{root}/marts")


def mart(spark, sf_dir, name):
    stored = stored_discrepancies if name == "discrepant" else stored_reports
    return stored_marts.read(spark, f"{stored(spark, sf_dir)}/marts", name)


@query("kpi_fraud_trend")
def q_k1(spark, sf_dir):
    return marts.fraud_trend(mart(spark, sf_dir, "totals"), AS_OF)


@query("kpi_top_accounts")
def q_k2(spark, sf_dir):
    return marts.top_accounts(mart(spark, sf_dir, "alerted"), AS_OF)


@query("kpi_geo_exposure")
def q_k3(spark, sf_dir):
    return marts.geo_exposure(mart(spark, sf_dir, "alerted"), fx.dim_geo_risk(spark))


@query("kpi_channel")
def q_k4(spark, sf_dir):
    return marts.channel_breakdown(mart(spark, sf_dir, "totals"), AS_OF)


@query("kpi_high_risk_mcc")
def q_k7(spark, sf_dir):
    # 30-day look-back: the one-day default has no qualifying group in the test data.
    return marts.high_risk_mcc(mart(spark, sf_dir, "risky"), AS_OF, days=30)


@query("kpi_high_risk_mcc_day")
def q_k7_day(spark, sf_dir):
    # the test data has no group above the report's threshold of 3 on one day
    return marts.high_risk_mcc(mart(spark, sf_dir, "risky"), AS_OF, days=1, min_count=0)


@query("kpi_discrepancy_audit")
def q_k5(spark, sf_dir):
    return marts.discrepancy_audit(mart(spark, sf_dir, "discrepant"), AS_OF)


@query("kpi_recon_accuracy")
def q_k6(spark, sf_dir):
    return marts.recon_accuracy(mart(spark, sf_dir, "totals"), mart(spark, sf_dir, "discrepant"), AS_OF)


@query("serving_daily_kpis")
def q_serving_kpis(spark, sf_dir):
    return serving.shaped(kpis.daily_kpis(gold(spark, sf_dir)), "daily_fraud_kpis", RUN_TS)


# --- reconciliation and batch features ----------------------------------
@query("recon_discrepancies")
def q_disc(spark, sf_dir):
    return disc(spark, sf_dir)


@query("recon_summary")
def q_recon_summary(spark, sf_dir):
    return reconcile.recon_summary(rec(spark, sf_dir))


@query("batch_features")
def q_batch_features(spark, sf_dir):
    return features.batch_features(fx.batch(spark, sf_dir))




# --- Bronze / Silver ----------------------------------------------------
BATCH_ID = "20240131020000"
SOURCE_FILE = "landing/transactions"


def bronze_split(spark, sf_dir):
    return ingest.ingest_bronze(fx.txn_raw(spark, sf_dir), TEST_SALT, batch_id=BATCH_ID,
                                source_file=SOURCE_FILE)


def bronze(spark, sf_dir):
    return bronze_split(spark, sf_dir)[0]


@query("bronze_ingest")
def q_bronze(spark, sf_dir):
    return bronze(spark, sf_dir)


@query("bronze_quarantine")
def q_quarantine(spark, sf_dir):
    return bronze_split(spark, sf_dir)[1]


@query("dq_flags")
def q_dq_flags(spark, sf_dir):
    return quality.with_dq_flags(bronze(spark, sf_dir))


@query("dq_clean")
def q_dq_clean(spark, sf_dir):
    return quality.split_clean(bronze(spark, sf_dir))[0]


@query("dq_rejected")
def q_dq_rejected(spark, sf_dir):
    return quality.split_clean(bronze(spark, sf_dir))[1]


@query("dedup_latest")
def q_dedup(spark, sf_dir):
    return quality.dedup_latest(quality.split_clean(bronze(spark, sf_dir))[0])


@query("dq_orphan_accounts")
def q_orphans(spark, sf_dir):
    return quality.orphan_accounts(bronze(spark, sf_dir), fx.dim_account(spark, sf_dir))


@query("geo_mismatch")
def q_geo_mismatch(spark, sf_dir):
    return en.geo_mismatch(bronze(spark, sf_dir), fx.dim_account(spark, sf_dir))


def silver_tables(spark, sf_dir):
    mcc, geo = _dims(spark)
    return medallion.silver(bronze(spark, sf_dir), mcc, geo)


@query("silver_transactions")
def q_silver(spark, sf_dir):
    return silver_tables(spark, sf_dir)[0]


@query("gold_from_silver")
def q_gold_from_silver(spark, sf_dir):
    return medallion.gold_from_silver(silver_tables(spark, sf_dir)[0])


@query("run_metrics")
def q_run_metrics(spark, sf_dir):
    """The Bronze, Silver and Gold jobs run once; the report reads their ledger."""
    root = scratch_path(spark, "run")
    mcc, geo = _dims(spark)
    done = lambda job, values: metrics.record(spark, f"{root}/metrics", BATCH_ID, job, values, RUN_TS)
    done("bronze", medallion.run_bronze(spark, fx.txn_raw(spark, sf_dir), f"{root}/bronze", TEST_SALT, batch_id=BATCH_ID, source_file=SOURCE_FILE))
    rows = spark.read.schema(bronze(spark, sf_dir).schema).parquet(f"{root}/bronze")
    done("silver", medallion.run_silver(spark, rows, mcc, geo, f"{root}/silver", exists=False))
    silver = spark.read.schema(silver_tables(spark, sf_dir)[0].schema).parquet(f"{root}/silver")
    done("gold", medallion.run_gold(spark, silver, f"{root}/gold", f"{root}/kpis", f"{root}/alerts", RUN_TS))
    return metrics.run_metrics(metrics.read(spark, f"{root}/metrics")).drop("run_id")


@query("dq_gate")
def q_dq_gate(spark, sf_dir):
    return quality.dq_gate(gold(spark, sf_dir), rec(spark, sf_dir), days_before(AS_OF, 1))


@query("trailing_30d_outliers")
def q_trailing(spark, sf_dir):
    return scoring.trailing_outliers(fx.txn(spark, sf_dir)).select(
        "transaction_id", "account_id", "amount", "prior_txn_count", "trailing_avg",
        "trailing_std", "trailing_outlier_flag")


# --- scans and sinks (write to the shared folder, read back) ------------
JSON_BAD_EVERY = 211


@query("scan_json_raw")
def q_scan_json(spark, sf_dir):
    # the forms that producers write: no offset, Z, +00:00, another zone; with and without a fraction
    raw = fx.txn_raw(spark, sf_dir)
    form = F.pmod(F.col("event_id"), F.lit(4))
    stamps = ("transaction_ts", "updated_at")
    local = {c: F.when(form == 3, F.col(c) + F.make_dt_interval(hours=F.lit(2))).otherwise(F.col(c)) for c in stamps}
    raw = raw.withColumns(local)
    text = envl.event_json(raw, RAW_EVENT.names)
    zone = F.when(form == 1, "Z").when(form == 2, "+00:00").when(form == 3, "+02:00").otherwise("")
    text = F.regexp_replace(F.when(form % 2 == 1, F.replace(text, F.lit(".000000"), F.lit(""))).otherwise(text),
                            F.lit(f'("(?:{"|".join(stamps)})":"[^"]+)"'), F.concat(F.lit("$1"), zone, F.lit('"')))
    bad = F.pmod(F.col("event_id"), F.lit(JSON_BAD_EVERY)) == 0
    lines = raw.select(F.when(bad, F.substring(text, 1, 30)).otherwise(text).alias("value"))
    path = scratch_path(spark, "landing-json")
    lines.write.mode("overwrite").text(path)
    df = scans.scan_json(spark, path)
    return df.withColumn("is_corrupt", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


@query("sink_partitioned_roundtrip")
def q_sink_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold")
    writers.write_partitioned(gold(spark, sf_dir), path, ["txn_date", "region"], mode="overwrite")
    return scans.scan_partitioned(spark, path)


@query("scan_partitioned")
def q_scan_partitioned(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    writers.write_partitioned(bronze(spark, sf_dir), path, ["ingest_date", "region"], mode="append")
    return scans.scan_partitioned(spark, path)


@query("scan_merge_schema")
def q_scan_merge(spark, sf_dir):
    b = fx.batch(spark, sf_dir).drop("txn_date")
    path = scratch_path(spark, "extract")
    old = b.filter(F.col("transaction_ts") < ts_literal(dt.datetime(2024, 1, 16))).drop("fx_rate_to_usd", "device_id")
    new = b.filter(F.col("transaction_ts") >= ts_literal(dt.datetime(2024, 1, 16)))
    old.write.mode("overwrite").parquet(f"{path}/part=old")
    new.write.mode("overwrite").parquet(f"{path}/part=new")
    return scans.scan_merge_schema(spark, path).drop("part")


# --- incremental extract, upsert, history -------------------------------
SNAPSHOT_END = dt.date(2024, 1, 24)


def source_v1(spark, sf_dir):
    """The extract as it was after day 24."""
    return fx.batch(spark, sf_dir).filter(F.col("txn_date") <= F.lit(SNAPSHOT_END))


def source_v2(spark, sf_dir):
    """Today's extract: every row, plus re-delivered corrections of some rows."""
    b = fx.batch(spark, sf_dir)
    fixes = (b.filter(F.pmod("event_id", F.lit(17)) == 0)
             .withColumn("amount", (F.col("amount") + 5).cast("decimal(18,2)"))
             .withColumn("updated_at", F.col("updated_at") + F.make_dt_interval(days=F.lit(7))))
    return b.unionByName(fixes)


def watermarks_after_v1(spark, sf_dir):
    v1 = source_v1(spark, sf_dir)
    others = literal_table(
        spark, [("card_network_feed", "2024-01-29 00:00:00", "2024-01-29 03:00:00")], WATERMARKS)
    return inc.advance_watermark(spark, others, "core_banking_extract", v1,
                                 dt.datetime(2024, 1, 25, 2, 0))


def extract_v2(spark, sf_dir):
    wm = watermarks_after_v1(spark, sf_dir)
    mark = inc.watermark_value(wm, "core_banking_extract")
    return inc.extract_incremental(source_v2(spark, sf_dir), mark), wm


@query("incremental_extract")
def q_inc_extract(spark, sf_dir):
    return extract_v2(spark, sf_dir)[0]


@query("incremental_watermark")
def q_inc_watermark(spark, sf_dir):
    ext, wm = extract_v2(spark, sf_dir)
    return inc.advance_watermark(spark, wm, "core_banking_extract", ext, RUN_TS)


@query("upsert_merge")
def q_upsert(spark, sf_dir):
    ext, _ = extract_v2(spark, sf_dir)
    return inc.merge_frames(source_v1(spark, sf_dir), ext)


def incremental_job(spark, sf_dir):
    """(job, source schema) after three stored runs: the extract of day 24, today's, and today's again."""
    job = incremental_job_plan.Job(scratch_path(spark, "silver-extract"), "txn_date")
    for n, source in enumerate((source_v1, source_v2, source_v2)):
        incremental_job_plan.run(spark, job, lambda: source(spark, sf_dir), RUN_TS + dt.timedelta(days=n))
    return job, source_v1(spark, sf_dir).schema


@query("incremental_run")
def q_inc_run(spark, sf_dir):
    job, schema = incremental_job(spark, sf_dir)
    return incremental_job_plan.current_rows(spark, job, schema)


@query("incremental_ledger")
def q_inc_ledger(spark, sf_dir):
    job, _ = incremental_job(spark, sf_dir)
    ledger = incremental_job_plan.read_ledger(spark, job)
    return ledger.where(F.col("step").isin(incremental_job_plan.STAGED, incremental_job_plan.COMMITTED)) \
        .select("source_system", F.col("run_no").cast("int").alias("run_no"), "step", "mark", "rows", "recorded_at")


@query("compacted_table")
def q_compacted(spark, sf_dir):
    # appends of three producers leave three small files a day and region
    path, rows = scratch_path(spark, "fragmented"), fx.txn(spark, sf_dir)
    for n in range(3):
        part = rows.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == n)
        writers.write_partitioned(part, path, ["txn_date", "region"], mode="append")
    compaction.compact(spark, path)
    compaction.compact(spark, path)  # finds nothing to do
    return spark.read.schema(rows.schema).parquet(path)


@query("history_as_of")
def q_history(spark, sf_dir):
    versions = bronze(spark, sf_dir).withColumn("valid_from", F.col("ingest_ts"))
    return inc.as_of(versions, dt.datetime(2024, 1, 15, 12, 0))


@query("history_scd2")
def q_history_scd2(spark, sf_dir):
    versions = bronze(spark, sf_dir).withColumn("valid_from", F.col("ingest_ts"))
    return inc.build_history(versions)


# --- contracts ------------------------------------------------------------
def canonical_schema():
    from pyspark.sql import types as T
    return T.StructType(RAW_EVENT.fields + [T.StructField("wallet_provider", T.StringType())])


@query("contract_conformance")
def q_contract(spark, sf_dir):
    return ct.conformance(spark, fx.txn_raw(spark, sf_dir))


@query("align_schema")
def q_align(spark, sf_dir):
    return ct.align_schema(fx.txn_raw(spark, sf_dir), canonical_schema())


# --- stream operators, batch twins ---------------------------------------
CORRUPT_B64_EVERY = 89
BAD_JSON_EVERY = 83


def envelopes(spark, sf_dir, *beside):
    """Envelopes built from the landing data, with undecodable records, and columns ``beside`` them."""
    raw = fx.txn_raw(spark, sf_dir)
    text = envl.event_json(raw, RAW_EVENT.names)
    eid = F.col("event_id")
    data = (F.when(F.pmod(eid, F.lit(CORRUPT_B64_EVERY)) == 0, F.concat(F.lit("corrupt!"), eid.cast("string")))
            .when(F.pmod(eid, F.lit(BAD_JSON_EVERY)) == 0, envl.b64(F.substring(text, 1, 25)))
            .otherwise(envl.b64(text)))
    return raw.select(data.alias("data"), F.col("account_id").alias("partition_key"), *beside)


@query("stream_decode")
def q_stream_decode(spark, sf_dir):
    return envl.decode_envelope(envelopes(spark, sf_dir))


@query("stream_redact")
def q_stream_redact(spark, sf_dir):
    d = envl.decode_envelope(envelopes(spark, sf_dir))
    return envl.redact(d.filter(~F.col("decode_error")))


@query("stream_valid")
def q_stream_valid(spark, sf_dir):
    return envl.route(envl.decode_envelope(envelopes(spark, sf_dir)))[0]


@query("stream_dead_letter")
def q_stream_dead(spark, sf_dir):
    return envl.route(envl.decode_envelope(envelopes(spark, sf_dir)))[1]


# --- streams replayed over landed files ----------------------------------
def replayed(spark, landings, start):
    """Land the files of each frame in turn and run the stream over them until it has read all."""
    root = scratch_path(spark, "replay")
    for rows in landings:
        rows.write.mode("append").parquet(f"{root}/landing")
        start(f"{root}/landing", root).awaitTermination()
    return f"{root}/out"


def by_thirds(df, day):
    """The rows of days 1 to 10, 11 to 20 and the rest: the order in which they land."""
    third = F.least(F.floor((F.dayofmonth(day) - 1) / 10), F.lit(2))
    return [df.filter(third == n) for n in range(3)]


def file_stream(spark, schema, build):
    """Start ``build`` over a Parquet landing folder into a Parquet table, with the checkpoint beside it."""
    def start(landing, root):
        out = build(spark.readStream.schema(schema).parquet(landing))
        return (out.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    return start


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    cols = ["transaction_id", "account_id", "mcc_code", "country_code", "channel", "region", "transaction_ts"]
    raw = fx.txn_raw(spark, sf_dir).filter("transaction_id IS NOT NULL AND transaction_ts IS NOT NULL").select(*cols)
    out = replayed(spark, by_thirds(raw, "transaction_ts"), file_stream(spark, raw.schema, stream_jobs.dedup_stream))
    return spark.read.schema(raw.schema).parquet(out)


@query("stream_windowed_kpis")
def q_stream_windows(spark, sf_dir):
    rows = scans.scan_partitioned(spark, f"{stored_gold(spark, sf_dir)}/gold", gold(spark, sf_dir).schema)
    out = replayed(spark, by_thirds(rows, "txn_date"), file_stream(spark, rows.schema, stream_jobs.windowed_kpis))
    return spark.read.parquet(out)


@query("stream_velocity")
def q_stream_velocity(spark, sf_dir):
    rows = fx.txn(spark, sf_dir).select("transaction_id", "account_id", "amount", "transaction_ts")
    # a third of a month lands at once: cells of a day keep the number of state keys low
    build = functools.partial(stream_jobs.velocity_stream, cell_s=86400, buckets=64)
    out = replayed(spark, by_thirds(rows, "transaction_ts"), file_stream(spark, rows.schema, build))
    return spark.read.parquet(out)


LATE_AFTER_S = 1800


def routed_replay(spark, sf_dir) -> str:
    """Folder of the routed rows and the batch metrics of envelopes, some of which land with the next third of the month."""
    env = envelopes(spark, sf_dir, "ingest_date")
    third = F.least(F.floor((F.dayofmonth("ingest_date") - 1) / 10), F.lit(2))
    landing = third + F.when(F.sha2("data", 256).endswith("0"), 1).otherwise(0)
    root = scratch_path(spark, "replay-routed")
    for n in range(4):
        env.filter(landing == n).select("data", "partition_key").write.mode("append").json(f"{root}/landing")
        stream_jobs.start_event_stream(spark, f"{root}/landing", f"{root}/out", checkpoint=f"{root}/checkpoint", failed_at=RUN_TS,
                                       late_after_s=LATE_AFTER_S, metrics_path=f"{root}/metrics").awaitTermination()
    return root


@query("stream_late_arrivals")
def q_stream_late(spark, sf_dir):
    """Late events go to the dead letter, none is lost."""
    rows = spark.read.parquet(f"{routed_replay(spark, sf_dir)}/out")
    return rows.select(F.col("batch_id").cast("long").alias("batch_id"), "partition_key", "payload_sha256", "route", "reason")


@query("stream_batch_metrics")
def q_stream_metrics(spark, sf_dir):
    return stream_jobs.read_batch_metrics(spark, f"{routed_replay(spark, sf_dir)}/metrics").drop("write_ms")


@query("schema_evolving_append")
def q_evolving(spark, sf_dir):
    """Two producers' versions in one table: the second brings two more columns."""
    path = scratch_path(spark, "evolving")
    cols = ["transaction_id", "account_id", "amount", "currency", "transaction_ts", "mcc_code", "country_code", "channel"]
    rows = fx.txn(spark, sf_dir)
    fields = [f for f in ct.TRANSACTION_CONTRACT if f["name"] in cols]
    half = ts_literal(dt.datetime(2024, 1, 16))
    evolving.append(spark, rows.filter(F.col("transaction_ts") < half).select(*cols), path, fields, ct.CONTRACT_REQUIRED)
    evolving.append(spark, rows.filter(F.col("transaction_ts") >= half).select(*cols, "device_id", "account_open_date"), path, fields, ct.CONTRACT_REQUIRED)
    return evolving.read(spark, path)


# --- free-text redaction -------------------------------------------------
@query("redact_free_text")
def q_redact_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", pan.count_pan_runs(F.col("text")).alias("pan_runs"),
                    pan.redact_text(F.col("text")).alias("text_redacted"))
