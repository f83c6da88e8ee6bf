"""Derived tables reproduce the published fixture counts (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from ledgerline.operators import quality, reconcile
from ledgerline.operators.velocity import velocity_signals
from ledgerline.params import RiskParams
from ledgerline.plans.registry import REGISTRY, bronze
from ledgerline.sources import fixtures as fx


def test_table_sizes(spark):
    assert fx.txn(spark, SF_SMALL).count() == 1000
    assert fx.txn_raw(spark, SF_SMALL).count() == 1100
    assert fx.batch(spark, SF_SMALL).count() == 996


def test_scoring_counts(spark):
    g = REGISTRY["gold_transactions"](spark, SF_SMALL)
    r = g.agg(F.count_if("velocity_flag").alias("v"), F.count_if("amount_outlier_flag").alias("o"),
              F.count_if("fraud_alert").alias("a"),
              F.sum(F.when(F.col("fraud_alert"), F.col("amount"))).alias("x")).first()
    assert (r.v, r.o, r.a) == (7, 15, 5)
    assert str(r.x) == "58129.20"


def test_quality_counts(spark):
    b = bronze(spark, SF_SMALL)
    clean, _ = quality.split_clean(b)
    assert clean.count() == 1043
    assert quality.dedup_latest(clean).count() == 945
    assert REGISTRY["bronze_quarantine"](spark, SF_SMALL).count() == 11


def test_reconcile_counts(spark):
    rec = reconcile.reconcile(fx.txn(spark, SF_SMALL), fx.batch(spark, SF_SMALL))
    got = {r[0]: r[1] for r in rec.groupBy("discrepancy_type").count().collect()}
    assert got == {"MATCH": 965, "AMOUNT_MISMATCH": 16, "MISSING_IN_BATCH": 19, "MISSING_IN_STREAM": 15}


def test_day_window_velocity(spark):
    v = velocity_signals(fx.txn(spark, SF_SMALL), RiskParams(velocity_window_s=86400))
    assert v.filter(F.col("txn_count_5min") >= 5).count() == 173


def test_high_risk_mcc_one_day_default(spark):
    from ledgerline.operators import kpis
    from ledgerline.params import AS_OF
    from ledgerline.plans.registry import gold
    # FIXTURES.md §4: the one-day report has 0 / 0 / 1 groups at sf0.001 / 0.01 / 0.1
    assert kpis.high_risk_mcc(gold(spark, SF_SMALL), AS_OF, days=1).count() == 0
    assert kpis.high_risk_mcc(gold(spark, "/root/testdata/sf0.1"), AS_OF, days=1).count() == 1
    assert kpis.high_risk_mcc(gold(spark, SF_SMALL), AS_OF, days=30).count() == 42
