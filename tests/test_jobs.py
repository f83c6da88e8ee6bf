"""Jobs with their sinks: end-to-end medallion run, repair, compaction, vault."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from small_tables import SF_SMALL
from ledgerline.params import TEST_SALT
from ledgerline.plans import medallion
from ledgerline.plans.registry import REGISTRY
from ledgerline.sinks import writers
from ledgerline.sources import fixtures as fx

RUN = dt.datetime(2024, 1, 31, 2)


def test_medallion_jobs_end_to_end(spark, tmp_path):
    b, s = str(tmp_path / "bronze"), str(tmp_path / "silver")
    g, k, a = str(tmp_path / "gold"), str(tmp_path / "kpi"), str(tmp_path / "alerts")
    m = medallion.run_bronze(spark, fx.txn_raw(spark, SF_SMALL), b, TEST_SALT, batch_id="20240131020000",
                             source_file="landing/transactions")
    assert m == {"bronze_rows": 1089, "quarantined": 11}
    again = medallion.run_bronze(spark, fx.txn_raw(spark, SF_SMALL), b, TEST_SALT, batch_id="20240131020000",
                                 source_file="landing/transactions")        # replayed batch
    assert again == m
    bronze = spark.read.parquet(b)
    assert bronze.count() == 1089 and spark.read.parquet(b + "_quarantine").count() == 11
    bronze = bronze.withColumn("batch_id", F.col("batch_id").cast("string"))
    mcc, geo = fx.dim_merchant_category(spark), fx.dim_geo_risk(spark)
    r1 = medallion.run_silver(spark, bronze, mcc, geo, s, exists=False)
    r2 = medallion.run_silver(spark, bronze, mcc, geo, s, exists=True)     # replay: idempotent
    assert r1["rejected"] == r2["rejected"] == 1089 - 1043
    silver = spark.read.parquet(s)
    assert silver.count() == 945
    assert silver.groupBy("transaction_id").count().filter("count > 1").count() == 0
    gm = medallion.run_gold(spark, silver, g, k, a, RUN)
    want = REGISTRY["gold_from_silver"](spark, SF_SMALL)
    assert gm["gold_rows"] == want.count() and gm["alerts"] == want.filter("fraud_alert").count()
    assert spark.read.parquet(a).count() == gm["alerts"]
    kp = spark.read.parquet(k)
    assert kp.agg(F.sum("txn_volume")).first()[0] == gm["gold_rows"]


def test_partition_repair(spark, tmp_path):
    path = str(tmp_path / "t")
    df = fx.txn(spark, SF_SMALL).select("transaction_id", "amount", "txn_date", "region")
    writers.write_partitioned(df, path, ["txn_date"], mode="append")
    writers.register_partitioned_table(spark, "ext_txn", path,
                                       "transaction_id string, amount decimal(18,2), region string, txn_date date",
                                       ["txn_date"])
    assert spark.sql("SHOW PARTITIONS ext_txn").count() == 30
    assert spark.table("ext_txn").count() == df.count()
    spark.sql("DROP TABLE ext_txn")


def test_vault_rotates_keys_without_showing_them(spark, tmp_path):
    from ledgerline.functions import vault as vt
    keys_at, path = str(tmp_path / "keys"), str(tmp_path / "vault")
    k1, k2, salt = b"0123456789abcdef0123456789abcdef", b"fedcba9876543210fedcba9876543210", "table-salt"
    spark.createDataFrame([(1, bytearray(k1), salt)], vt.KEYS).write.parquet(keys_at)
    read_keys = lambda: spark.read.schema(vt.KEYS).parquet(keys_at)
    cards = fx.txn(spark, SF_SMALL)
    first = cards.filter(F.pmod(F.xxhash64("card_number"), F.lit(2)) == 0)
    vt.store(vt.vault(first, read_keys()), path)
    spark.createDataFrame([(2, bytearray(k2), salt)], vt.KEYS).write.mode("append").parquet(keys_at)
    second = cards.filter(F.pmod(F.xxhash64("card_number"), F.lit(2)) == 1)
    vt.store(vt.vault(second, read_keys()), path)
    stored = lambda: spark.read.schema(vt.VAULT).parquet(path)
    want = {r[0] for r in cards.select("card_number").distinct().collect()}
    assert {r["key_id"] for r in stored().collect()} == {1, 2}
    assert {r["card_number"] for r in vt.unvault(stored(), read_keys()).collect()} == want  # both versions decrypt
    for df in (vt.vault(cards, read_keys()), vt.unvault(stored(), read_keys()), vt.rotated(stored(), read_keys())):
        text = df._jdf.queryExecution().toString()
        for secret in (k1, k2):
            assert secret.decode() not in text and secret.hex().upper() not in text.upper()
        assert salt not in text
    tokens = {r["card_number_token"] for r in stored().collect()}
    untouched = {r["card_number_token"]: bytes(r["ciphertext"]) for r in stored().where("key_id = 2").collect()}
    n1 = stored().where("key_id = 1").count()
    assert vt.rotate_stored(spark, path, read_keys()) == n1 and vt.rotate_stored(spark, path, read_keys()) == 0
    after = {r["card_number_token"]: (r["key_id"], bytes(r["ciphertext"])) for r in stored().collect()}
    assert set(after) == tokens and {k for k, _ in after.values()} == {2}
    assert all(after[t][1] == c for t, c in untouched.items())  # only older entries are re-encrypted
    only_new = read_keys().where("key_id = 2")
    assert {r["card_number"] for r in vt.unvault(stored(), only_new).collect()} == want


def test_evolving_append_is_readable_under_both_contracts(spark, tmp_path):
    from pyspark.sql import types as T
    from ledgerline.operators.contract import SchemaCompatibilityError
    from ledgerline.sinks import evolving
    path = str(tmp_path / "t")
    fields = [{"name": "id", "type": "string"}, {"name": "n", "type": "long"}, {"name": "note", "type": ["null", "string"]}]
    assert evolving.append(spark, spark.createDataFrame([("a", 1)], "id string, n int"), path, fields, ("id", "n")) == 1  # narrower, without note
    assert evolving.append(spark, spark.createDataFrame([("b", 2, "x")], "id string, n long, note string"), path, fields, ("id",)) == 1
    newer = spark.createDataFrame([("c", 3, dt.date(2024, 1, 1), "1.50")], "id string, n long, day date, price string")
    assert evolving.append(spark, newer.withColumn("price", F.col("price").cast("decimal(9,2)")), path, fields, ("id",)) == 2
    old, new = evolving.read(spark, path, 1), evolving.read(spark, path)
    assert sorted(map(tuple, old.collect())) == [("a", 1, None), ("b", 2, "x"), ("c", 3, None)]
    assert new.columns == ["id", "n", "note", "day", "price"] and new.schema["price"].dataType == T.DecimalType(9, 2)
    assert {r["id"]: r["day"] for r in new.collect()} == {"a": None, "b": None, "c": dt.date(2024, 1, 1)}
    for bad, why in ((spark.createDataFrame([(1,)], "n long"), "id is missing"), (spark.createDataFrame([("d", "x")], "id string, n string"), "n is string"),
                     (spark.createDataFrame([("d", 1.5)], "id string, n double"), "n is double")):
        with pytest.raises(SchemaCompatibilityError, match=why):
            evolving.append(spark, bad, path, fields, ("id",))
    assert evolving.read(spark, path).count() == 3 and evolving.versions(spark, path) == [1, 2]
    assert evolving.check_change(fields, fields[:2]) == ["note is gone"]
    assert evolving.check_change(fields, [*fields, {"name": "z", "type": "int"}]) == ["z is new and not nullable"]
    assert evolving.check_change(fields, [{**fields[0], "type": "int"}, *fields[1:]]) == ["id changes from string to int"]


def test_serving_tables_are_shaped_checked_and_loaded(spark):
    from ledgerline.plans import serving
    from ledgerline.plans.registry import disc, gold
    from ledgerline.operators import kpis
    loaded = {}
    g = gold(spark, SF_SMALL)
    frames = {"daily_fraud_kpis": kpis.daily_kpis(g), "fraud_alerts": g.filter("fraud_alert"), "reconciliation_discrepancies": disc(spark, SF_SMALL).drop("resolved"),
              "dim_merchant_category": fx.dim_merchant_category(spark), "dim_geo_risk": fx.dim_geo_risk(spark).drop("fatf_watchlist")}
    assert set(serving.load_all(frames, lambda df, t: loaded.__setitem__(t, df), RUN)) == set(serving.TABLES)
    for table, df in loaded.items():
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in serving.TABLES[table].fields]
        assert df.count() > 0
    assert {r["resolved"] for r in loaded["reconciliation_discrepancies"].collect()} == {False}
    assert {r["loaded_at"] for r in loaded["daily_fraud_kpis"].collect()} == {RUN} and loaded["dim_geo_risk"].filter("fatf_watchlist").count() == 0
    with pytest.raises(Exception, match="NOT NULL"):
        serving.shaped(g.withColumn("account_id", F.lit(None).cast("string")), "fraud_alerts", RUN).collect()
    with pytest.raises(ValueError, match="no such"):
        serving.load_all({"other": g}, print, RUN)


def test_marts_follow_late_corrections(spark, tmp_path):
    from ledgerline.operators import kpis, marts
    from ledgerline.params import AS_OF
    from ledgerline.plans import marts as stored
    from ledgerline.plans.registry import disc, gold
    g, root = gold(spark, SF_SMALL).cache(), str(tmp_path)
    alerts, d = medallion.fraud_alerts(g.withColumn("fraud_alert", F.col("amount") > 3000), RUN).cache(), disc(spark, SF_SMALL).cache()
    days = sorted(r[0] for r in g.select("txn_date").distinct().collect())
    stored.refresh(spark, root, days, g, alerts, d)
    # corrections to two days: amounts, flags, a removed region, and a day that loses all its rows
    fixed = (g.where(F.col("txn_date") != F.lit(days[3])).withColumn("fraud_alert", F.col("fraud_alert") | ((F.col("txn_date") == F.lit(days[-1])) & (F.col("channel") == "ATM")))
             .where(~((F.col("txn_date") == F.lit(days[-1])) & (F.col("region") == "EU"))))
    fixed_alerts = medallion.fraud_alerts(fixed.withColumn("fraud_alert", F.col("amount") > 3000), RUN)
    fixed_disc = d.where(F.col("txn_date") != F.lit(days[-1]))
    stored.refresh(spark, root, [days[3], days[-1]], fixed, fixed_alerts, fixed_disc)
    m = {n: stored.read(spark, root, n) for n in stored.TYPES}
    both = [(marts.fraud_trend(m["totals"], AS_OF), kpis.fraud_trend(fixed, AS_OF)), (marts.top_accounts(m["alerted"], AS_OF, 30), kpis.top_accounts(fixed_alerts, AS_OF, 30)),
            (marts.geo_exposure(m["alerted"], fx.dim_geo_risk(spark)), kpis.geo_exposure(fixed_alerts, fx.dim_geo_risk(spark))),
            (marts.channel_breakdown(m["totals"], AS_OF), kpis.channel_breakdown(fixed, AS_OF)), (marts.discrepancy_audit(m["discrepant"], AS_OF, 30), kpis.discrepancy_audit(fixed_disc, AS_OF, 30)),
            (marts.recon_accuracy(m["totals"], m["discrepant"], AS_OF), kpis.recon_accuracy(fixed, fixed_disc, AS_OF)),
            (marts.high_risk_mcc(m["risky"], AS_OF, 30, 0), kpis.high_risk_mcc(fixed, AS_OF, 30, 0))]
    for got, want in both:
        assert got.columns == want.columns and list(map(tuple, got.collect())) == list(map(tuple, want.collect())) != []
        assert all("parquet" not in f or root in f for f in got.inputFiles())  # stored partials alone
    assert m["totals"].where(F.col("txn_date") == F.lit(days[3])).count() == 0
    empty = marts.recon_accuracy(m["totals"], m["discrepant"], dt.date(2030, 1, 1)).first()
    assert tuple(empty) == (0, 0, None)


def test_metrics_ledger_equals_a_recount(spark, tmp_path):
    from ledgerline.operators import quality
    from ledgerline.plans import metrics
    from ledgerline.plans.registry import bronze_split
    path = str(tmp_path / "metrics")
    metrics.record(spark, path, "r1", "bronze", {"bronze_rows": 5, "quarantined": 1}, dt.datetime(2024, 1, 1))
    metrics.record(spark, path, "r1", "bronze", {"bronze_rows": 7, "quarantined": 2}, dt.datetime(2024, 1, 2))  # replayed
    assert {r["metric"]: r["value"] for r in metrics.read(spark, path).collect()} == {"bronze_rows": 7, "quarantined": 2}
    got = REGISTRY["run_metrics"](spark, SF_SMALL).first()
    valid, quarantined = bronze_split(spark, SF_SMALL)
    n = {k: v for k, v in quality.with_dq_flags(valid).groupBy(F.size("dq_flags") == 0).count().collect()}
    g = REGISTRY["gold_from_silver"](spark, SF_SMALL)
    assert tuple(got) == (valid.count() + quarantined.count(), quarantined.count(), n[False], n[True], g.count(), g.filter("fraud_alert").count())


def test_gold_keeps_textual_regions(spark, tmp_path):
    s = REGISTRY["silver_transactions"](spark, SF_SMALL).withColumn("region", F.when(F.col("region") == "EU", "01").otherwise("1"))
    g, k, a, m = (str(tmp_path / x) for x in "gkam")
    got = medallion.run_gold(spark, s, g, k, a, RUN, marts_path=m)
    assert {r["region"] for r in spark.read.schema("region string, txn_volume long, txn_date date").parquet(k).collect()} == {"01", "1"}
    assert {r["region"] for r in spark.read.schema("region string, txn_date date").parquet(f"{m}/totals").collect()} == {"01", "1"}
    assert got["undated"] == 0 and spark.read.parquet(a).count() == got["alerts"]


def test_batch_transform_and_reconcile_jobs(spark, tmp_path):
    src = str(tmp_path / "extract")
    fx.batch(spark, SF_SMALL).drop("txn_date").write.parquet(src)
    n = medallion.run_batch_transform(spark, src, str(tmp_path / "features"))
    assert n == 996
    feats = spark.read.parquet(str(tmp_path / "features"))
    assert feats.count() == 996 and {"amount_usd", "txn_dow", "is_weekend"} <= set(feats.columns)
    m = medallion.run_reconcile(spark, fx.txn(spark, SF_SMALL), fx.batch(spark, SF_SMALL),
                                str(tmp_path / "disc"), RUN)
    assert m == {"total_count": 1015, "matched_count": 981, "exact_match_count": 965}
    assert spark.read.parquet(str(tmp_path / "disc")).count() == 1015 - 965


def test_bronze_source_file_from_scan_metadata(spark, tmp_path):
    from ledgerline.operators.ingest import ingest_bronze
    from ledgerline.schemas import RAW_EVENT
    from ledgerline.sources.scans import scan_json
    from ledgerline.streaming.envelope import event_json
    raw = fx.txn_raw(spark, SF_SMALL)
    path = str(tmp_path / "landing")
    raw.select(event_json(raw, RAW_EVENT.names).alias("value")).write.text(path)
    valid, quarantine = ingest_bronze(scan_json(spark, path), TEST_SALT, dt.datetime(2024, 1, 31, 2))
    row = valid.select("source_file", "batch_id", "ingest_ts", "ingest_date").first()
    assert row.source_file.startswith("file:") and "landing" in row.source_file
    assert row.batch_id == "20240131020000" and row.ingest_date == dt.date(2024, 1, 31)
    assert valid.count() + quarantine.count() == 1100
    assert "card_number" not in valid.columns


def test_scan_current_reads_open_versions(spark, tmp_path):
    from ledgerline.operators import incremental as inc
    from ledgerline.plans.registry import bronze
    from ledgerline.sources.scans import scan_current
    versions = bronze(spark, SF_SMALL).withColumn("valid_from", F.col("ingest_ts"))
    path = str(tmp_path / "history")
    inc.build_history(versions).write.parquet(path)
    current = scan_current(spark, path)
    assert current.count() == versions.select("transaction_id").distinct().count()
    assert current.groupBy("transaction_id").count().filter("count > 1").count() == 0
    latest = versions.groupBy("transaction_id").agg(F.max("valid_from").alias("valid_from"))
    assert current.join(latest, ["transaction_id", "valid_from"], "left_anti").count() == 0


def test_ship_package_zips_the_package(spark):
    import zipfile
    from ledgerline.runtime import ship_package
    path = ship_package(spark)
    names = zipfile.ZipFile(path).namelist()
    assert "ledgerline/__init__.py" in names and "ledgerline/streaming/jobs.py" in names
    assert all(n.endswith(".py") for n in names)
