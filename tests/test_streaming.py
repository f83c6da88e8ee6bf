"""Streaming jobs replayed over files equal their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from ledgerline.operators.velocity import velocity_signals
from ledgerline.plans.registry import envelopes, q_stream_dead, q_stream_valid
from ledgerline.schemas import RAW_EVENT
from ledgerline.sources import fixtures as fx
from ledgerline.streaming import jobs, statistics
from ledgerline.functions.timefn import ts_literal

RUN = dt.datetime(2024, 1, 31, 2)


def rows(df, drop=()):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_event_stream_routes_like_the_batch_twin_and_restarts(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "routed")
    ckpt = str(tmp_path / "ckpt")
    env = envelopes(spark, SF_SMALL).withColumn("_h", F.abs(F.hash("data")) % 3)
    env.filter("_h = 0").drop("_h").write.mode("append").json(src)
    env.filter("_h = 1").drop("_h").write.mode("append").json(src)
    q = jobs.start_event_stream(spark, src, out, checkpoint=ckpt, failed_at=RUN)
    q.awaitTermination()
    m = [p["observedMetrics"]["routing"] for p in q.recentProgress if p["numInputRows"]]
    assert m and all(x["events"] == x["valid"] + x["schema_failed"] + x["decode_failed"] and x["redacted"] <= x["events"] for x in m)
    env.filter("_h = 2").drop("_h").write.mode("append").json(src)   # new arrivals
    q = jobs.start_event_stream(spark, src, out, checkpoint=ckpt, failed_at=RUN)
    q.awaitTermination()
    got_valid, got_dead = jobs.read_routed(spark, out)
    assert got_dead.filter(F.col("failed_at") != F.lit(RUN)).count() == 0
    got_valid, got_dead = got_valid.drop("batch_id"), got_dead.drop("batch_id", "failed_at")
    assert rows(got_valid) == rows(q_stream_valid(spark, SF_SMALL))
    assert rows(got_dead) == rows(q_stream_dead(spark, SF_SMALL))


def _event_files(spark, tmp_path, df, parts=3):
    """Files arrive in event-time order (days 1-10, 11-20, ...)."""
    src = str(tmp_path / "events")
    d = df.withColumn("_p", F.least(F.floor((F.dayofmonth("transaction_ts") - 1) / 10), F.lit(parts - 1)))
    for i in range(parts):
        d.filter(F.col("_p") == i).drop("_p").write.mode("append").parquet(src)
    return src


def _stream(spark, src, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)


def test_dedup_stream_keeps_one_per_id(spark, tmp_path):
    raw = fx.txn_raw(spark, SF_SMALL).filter(F.col("transaction_id").isNotNull()
                                             & F.col("transaction_ts").isNotNull())
    raw = raw.select(*[c for c in RAW_EVENT.names])
    src = _event_files(spark, tmp_path, raw)
    out = jobs.dedup_stream(_stream(spark, src, raw.schema), delay="2 hours")
    q = (out.writeStream.format("memory").queryName("dedup_out").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("dedup_out")
    assert got.count() == raw.select("transaction_id").distinct().count()
    assert got.groupBy("transaction_id").count().filter("count > 1").count() == 0


def test_windowed_kpis_match_batch_hours(spark, tmp_path):
    t = fx.txn(spark, SF_SMALL)
    sentinel = t.limit(1).withColumn("transaction_ts", ts_literal(dt.datetime(2024, 3, 1))) \
        .withColumn("transaction_id", F.lit("sentinel")).withColumn("fraud_alert", F.lit(False))
    g = t.withColumn("fraud_alert", F.col("amount") > 2000)
    src = _event_files(spark, tmp_path, g)
    sentinel.select(*g.columns).write.mode("append").parquet(src)
    out = jobs.windowed_kpis(_stream(spark, src, g.schema), window="1 hour", delay="6 hours")
    q = (out.writeStream.format("memory").queryName("kpi_out").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("kpi_out").filter(F.col("window_start") < ts_literal(dt.datetime(2024, 2, 1)))
    batch = (g.withColumn("window_start", F.date_trunc("hour", "transaction_ts").cast("timestamp_ntz"))
             .groupBy("window_start", "region", "channel")
             .agg(F.count("transaction_id").alias("txn_volume"),
                  F.count_if("fraud_alert").alias("flagged_txn_count")))
    a = rows(got.select("window_start", "region", "channel", "txn_volume", "flagged_txn_count"))
    # windows still open when the last micro-batch ran are not emitted yet
    assert a and set(a) <= set(rows(batch))


def test_velocity_stream_equals_batch(spark, tmp_path):
    t = fx.txn(spark, SF_SMALL).select("transaction_id", "account_id", "amount", "transaction_ts")
    src = _event_files(spark, tmp_path, t, parts=4)
    far = spark.createDataFrame([("flush", "acct_flush", None, dt.datetime(2024, 6, 1))],
                                "transaction_id string, account_id string, amount decimal(18,2), "
                                "transaction_ts timestamp_ntz")
    far.write.mode("append").parquet(src)
    flush2 = far.withColumn("transaction_ts", ts_literal(dt.datetime(2024, 6, 2)))
    flush2.write.mode("append").parquet(src)
    out = jobs.velocity_stream(_stream(spark, src, t.schema), delay="3 hours")
    q = (out.writeStream.format("memory").queryName("vel_out").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("vel_out").filter(F.col("account_id") != "acct_flush")
    want = velocity_signals(t).select(*got.columns)
    assert rows(got) == rows(want)


def test_stream_static_enrichment(spark, tmp_path):
    from ledgerline.operators.enrich import enrich
    t = fx.txn(spark, SF_SMALL)
    src = _event_files(spark, tmp_path, t)
    out = enrich(_stream(spark, src, t.schema), fx.dim_merchant_category(spark), fx.dim_geo_risk(spark))
    q = (out.writeStream.format("memory").queryName("enriched_out").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    want = enrich(t, fx.dim_merchant_category(spark), fx.dim_geo_risk(spark))
    assert rows(spark.table("enriched_out")) == rows(want.select(*spark.table("enriched_out").columns))


def test_latency_listener_records_slow_batches(spark, tmp_path):
    listener = jobs.LatencyListener(budget_ms=0)
    spark.streams.addListener(listener)
    try:
        src, out = str(tmp_path / "src"), str(tmp_path / "routed")
        envelopes(spark, SF_SMALL).write.json(src)
        jobs.start_event_stream(spark, src, out, checkpoint=str(tmp_path / "ck")).awaitTermination()
        import time
        for _ in range(50):
            if listener.slow:
                break
            time.sleep(0.1)
        assert listener.slow
    finally:
        spark.streams.removeListener(listener)


def test_windowed_kpis_drop_and_count_late_rows(spark, tmp_path):
    t = fx.txn(spark, SF_SMALL).withColumn("fraud_alert", F.lit(False))
    src = _event_files(spark, tmp_path, t)
    late = t.limit(3).withColumn("transaction_ts", ts_literal(dt.datetime(2024, 1, 2))) \
        .withColumn("transaction_id", F.concat(F.lit("late_"), F.col("transaction_id")))
    late.write.mode("append").parquet(src)          # arrives after the watermark passed Jan 2
    out = jobs.windowed_kpis(_stream(spark, src, t.schema), window="1 hour", delay="30 minutes")
    q = (out.writeStream.format("memory").queryName("kpi_late").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for op in p.get("stateOperators", []))
    # counted after partial aggregation: late rows of one group count once
    assert dropped >= 1
    hour = ts_literal(dt.datetime(2024, 1, 2))
    got = spark.table("kpi_late").filter(F.col("window_start") == hour).agg(F.sum("txn_volume")).first()[0]
    on_time = t.filter(F.date_trunc("hour", "transaction_ts").cast("timestamp_ntz") == hour).count()
    assert (got or 0) == on_time


def test_score_stream_equals_batch_scoring(spark, tmp_path):
    from ledgerline.operators.scoring import account_stats
    from ledgerline.plans.medallion import score_transactions
    t = fx.txn(spark, SF_SMALL).select("transaction_id", "account_id", "amount", "transaction_ts",
                                       "currency", "mcc_code", "country_code", "channel", "region")
    src = _event_files(spark, tmp_path, t)
    flush = t.limit(1).withColumn("transaction_id", F.lit("flush")).withColumn("account_id", F.lit("acct_flush")) \
        .withColumn("transaction_ts", ts_literal(dt.datetime(2024, 6, 1)))
    flush.write.mode("append").parquet(src)
    flush.withColumn("transaction_ts", ts_literal(dt.datetime(2024, 6, 2))).write.mode("append").parquet(src)
    mcc, geo = fx.dim_merchant_category(spark), fx.dim_geo_risk(spark)
    out = jobs.score_stream(_stream(spark, src, t.schema), mcc, geo, account_stats(t), delay="3 hours")
    q = (out.writeStream.format("memory").queryName("scored_out").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    cols = ["transaction_id", "txn_count_5min", "velocity_flag", "amount_outlier_flag", "geo_risk_score",
            "high_risk_mcc_flag", "fraud_risk_score", "fraud_alert", "channel", "region"]
    got = spark.table("scored_out").filter(F.col("account_id") != "acct_flush").select(*cols)
    want = score_transactions(fx.txn(spark, SF_SMALL), mcc, geo).select(*cols)
    assert rows(got) == rows(want)
    assert got.filter("fraud_alert").count() == 5


def test_velocity_stream_out_of_order_within_delay(spark, tmp_path):
    """Half of each two-day chunk arrives with the next chunk (up to two days
    late, inside a three-day watermark delay): output still equals batch."""
    t = fx.txn(spark, SF_SMALL).select("transaction_id", "account_id", "amount", "transaction_ts")
    src = str(tmp_path / "events")
    chunk = F.floor((F.dayofmonth("transaction_ts") - 1) / 2)
    late = F.abs(F.hash("transaction_id")) % 2 == 1
    d = t.withColumn("_file", chunk + F.when(late, 1).otherwise(0))
    for i in range(17):
        d.filter(F.col("_file") == i).drop("_file").write.mode("append").parquet(src)
    far = spark.createDataFrame([("flush", "acct_flush", None, dt.datetime(2024, 6, 1))], t.schema)
    far.write.mode("append").parquet(src)
    far.withColumn("transaction_ts", ts_literal(dt.datetime(2024, 6, 5))).write.mode("append").parquet(src)
    out = jobs.velocity_stream(_stream(spark, src, t.schema), delay="3 days")
    q = (out.writeStream.format("memory").queryName("vel_ooo").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("vel_ooo").filter(F.col("account_id") != "acct_flush")
    want = velocity_signals(t).select(*got.columns)
    assert got.count() == t.count()
    assert rows(got) == rows(want)


def test_scoring_stream_end_to_end_from_envelopes(spark, tmp_path):
    from ledgerline.operators.scoring import account_stats
    from ledgerline.plans.registry import gold
    from ledgerline.streaming.envelope import encode_envelope
    t = fx.txn(spark, SF_SMALL)
    src = str(tmp_path / "env")
    day = F.floor((F.dayofmonth("transaction_ts") - 1) / 10)
    for i in range(3):                                       # arrivals in event-time order,
        part = t.filter(day == i)                            # some events delivered twice
        encode_envelope(part.unionByName(part.filter(F.pmod("event_id", F.lit(10)) == 0))) \
            .write.mode("append").json(src)
    flush = t.limit(1).withColumn("transaction_id", F.lit("flush")).withColumn("account_id", F.lit("acct_flush"))
    for when in (dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2)):
        encode_envelope(flush.withColumn("transaction_ts", ts_literal(when))).write.mode("append").json(src)
    out, stats = str(tmp_path / "scored"), str(tmp_path / "stats")
    assert statistics.publish(spark, account_stats(t), stats) == 1
    q = jobs.start_scoring_stream(spark, src, out, fx.dim_merchant_category(spark), fx.dim_geo_risk(spark),
                                  stats, delay="3 hours", checkpoint=str(tmp_path / "ck"),
                                  max_files_per_trigger=4)
    q.awaitTermination()
    got = spark.read.parquet(out).filter(F.col("account_id") != "acct_flush")
    want = gold(spark, SF_SMALL)
    cols = ["transaction_id", "fraud_risk_score", "fraud_alert", "velocity_flag", "amount_outlier_flag"]
    assert got.count() == t.count()
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_velocity_cells_split_a_hot_account(spark, tmp_path):
    """One account, cells as narrow as the window: the state has a key for each cell, results stay exact."""
    t = fx.txn(spark, SF_SMALL).select("transaction_id", F.lit("hot").alias("account_id"), "amount", "transaction_ts")
    src = _event_files(spark, tmp_path, t, parts=2)
    far = spark.createDataFrame([("flush", "acct_flush", None, dt.datetime(2024, 6, 1))], t.schema)
    far.write.mode("append").parquet(src)
    far.withColumn("transaction_ts", ts_literal(dt.datetime(2024, 6, 2))).write.mode("append").parquet(src)
    out = jobs.velocity_stream(_stream(spark, src, t.schema), delay="3 hours", cell_s=300)
    q = (out.writeStream.format("memory").queryName("vel_hot").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = spark.table("vel_hot").filter(F.col("account_id") != "acct_flush")
    assert rows(got) == rows(velocity_signals(t).select(*got.columns))
    # seconds that no later window reaches are gone; each batch wrote the seconds it touched, not the account's history
    states = [op for p in q.recentProgress for op in p.get("stateOperators", [])]
    assert states and states[-1]["numRowsTotal"] <= 10
    assert sum(op["numRowsUpdated"] for op in states) <= 8 * t.count()


def test_state_function_needs_no_package_import():
    import os
    import subprocess
    import sys
    from pyspark import cloudpickle
    from ledgerline.params import RiskParams
    p = RiskParams()
    blob = cloudpickle.dumps(jobs.velocity_processor(p.velocity_window_s, p.velocity_count, p.velocity_amount * 100))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = ("import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); "
            "import importlib.util; assert importlib.util.find_spec('ledgerline') is None; print(callable(f.handleInputRows))")
    out = subprocess.run([sys.executable, "-c", code], input=blob, capture_output=True, cwd="/", env=env,
                         timeout=120)
    assert out.returncode == 0, out.stderr.decode()[-500:]
    assert out.stdout.strip() == b"True"      # a worker without the package can run it


def test_late_rows_go_to_the_dead_letter_and_none_is_lost(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "routed"), str(tmp_path / "ckpt")
    env = envelopes(spark, SF_SMALL).withColumn("_h", F.pmod(F.xxhash64("data"), F.lit(5)))  # shuffled arrivals
    for n in range(5):
        env.filter(F.col("_h") == n).drop("_h").write.mode("append").json(src)
        jobs.start_event_stream(spark, src, out, checkpoint=ckpt, failed_at=RUN, late_after_s=5 * 86400).awaitTermination()
    valid, dead = jobs.read_routed(spark, out)
    assert valid.count() + dead.count() == env.count()
    late = dead.filter(F.col("reason") == "LATE_ARRIVAL")
    assert late.count() > 100 and late.filter("event_redacted IS NULL").count() == 0
    # the first batch has no mark; later ones keep nothing that is behind it
    assert late.filter("batch_id = 0").count() == 0
    for n in range(1, 5):
        mark = jobs.read_mark(spark, out, n - 1)
        oldest = valid.filter(F.col("batch_id") == n).agg(F.min("transaction_ts")).first()[0]
        assert oldest >= mark - dt.timedelta(days=5)
    # a replayed batch is judged by the same mark and replaces itself
    before = rows(spark.read.parquet(out))
    again = env.filter("_h = 3").drop("_h").withColumn("_x", F.lit(1)).drop("_x")
    jobs.route_batch(out, RUN, 5 * 86400)(jobs.decode_envelope(again), 3)
    assert rows(spark.read.parquet(out)) == before
    valid, _ = jobs.read_routed(spark, out)  # the replayed batch has new files
    # the windows of the valid rows lose nothing to the watermark
    v = valid.withColumn("fraud_alert", F.lit(False))
    landed = str(tmp_path / "valid")
    for n in range(5):
        v.filter(F.col("batch_id") == n).write.mode("append").parquet(landed)
        k = jobs.windowed_kpis(spark.readStream.schema(v.schema).parquet(landed), delay="5 days")
        q = (k.writeStream.format("parquet").option("path", str(tmp_path / "kpis")).option("checkpointLocation", str(tmp_path / "kck"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert sum(op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", [])) == 0


def test_statistics_are_looked_up_for_every_batch(spark, tmp_path):
    from ledgerline.operators.scoring import account_stats
    t = fx.txn(spark, SF_SMALL).select("transaction_id", "account_id", "amount", "transaction_ts", "currency", "mcc_code",
                                       "country_code", "channel", "region").withColumns({"txn_count_5min": F.lit(1), "velocity_flag": F.lit(False)}).limit(50).cache()
    out, stats = str(tmp_path / "scored"), str(tmp_path / "stats")
    # tight statistics: whatever is far from 1.00 is an outlier; wide ones: nothing is
    ids = [r[0] for r in t.select("account_id").distinct().collect()]
    tight = spark.createDataFrame([(a, v) for a in ids for v in (0.99, 1.00, 1.01)], "account_id string, amount double").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    wide = spark.createDataFrame([(a, v) for a in ids for v in (0, 10**9)], "account_id string, amount long").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    write = jobs.score_batch(out, stats, fx.dim_merchant_category(spark), fx.dim_geo_risk(spark))
    write(t, 0)  # no statistics yet
    statistics.publish(spark, account_stats(tight), stats)
    write(t, 1)
    assert statistics.publish(spark, account_stats(wide), stats) == 2
    write(t, 2)
    write(t, 1)  # replayed after the statistics moved on
    got = {r["batch_id"]: r for r in spark.read.parquet(out).groupBy("batch_id").agg(
        F.min("stats_version").alias("v0"), F.max("stats_version").alias("v1"), F.count_if("amount_outlier_flag").alias("n"), F.count("*").alias("rows")).collect()}
    assert [(got[b]["v0"], got[b]["v1"]) for b in range(3)] == [(0, 0), (1, 1), (2, 2)]
    assert got[0]["n"] == 0 and got[1]["n"] > 40 and got[2]["n"] == 0 and {got[b]["rows"] for b in got} == {50}
    # what a crash left without _SUCCESS is no version
    import os
    os.makedirs(f"{stats}/version=3")
    assert statistics.latest(spark, stats) == 2 and statistics.expire(spark, stats, keep=1) == [1]
