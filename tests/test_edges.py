"""Hand-made rows for the edge cases of each rule."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.numeric import round_ratio
from ledgerline.functions.pan import mask_pan, pan_token, redact_text
from ledgerline.operators import quality, reconcile, scoring
from ledgerline.operators.velocity import velocity_signals
from reference_forms import velocity_by_self_join
from ledgerline.params import TEST_SALT

SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("currency", T.StringType()),
    T.StructField("transaction_ts", T.TimestampNTZType()),
])
T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_currency_rule(spark):
    df = rows(spark, [("a", "x", Decimal("1"), None, T0), ("b", "x", Decimal("1"), "usd", T0),
                      ("c", "x", Decimal("1"), "USD\n", T0), ("d", "x", Decimal("1"), "USD", T0),
                      ("e", "x", Decimal("0"), "USD", None)])
    got = {r.transaction_id: r.dq_flags for r in quality.with_dq_flags(df).collect()}
    assert got["a"] == ["INVALID_CURRENCY"]
    assert got["b"] == ["INVALID_CURRENCY"]
    assert got["c"] == ["INVALID_CURRENCY"]
    assert got["d"] == []
    assert got["e"] == ["INVALID_AMOUNT", "MISSING_TIMESTAMP"]
    clean, rej = quality.split_clean(df)
    assert clean.count() + rej.count() == df.count()


def test_velocity_boundary_300_in_301_out(spark):
    t = lambda s: T0 + dt.timedelta(seconds=s)
    df = rows(spark, [("a", "x", Decimal("6000"), "USD", t(0)),
                      ("b", "x", Decimal("4000"), "USD", t(300)),
                      ("c", "x", Decimal("1"), "USD", t(601)),
                      ("d", "x", Decimal("1"), "USD", t(601.5)),
                      ("e", "y", Decimal("1"), "USD", None)])
    got = {r.transaction_id: (r.txn_count_5min, r.txn_sum_5min, r.velocity_flag)
           for r in velocity_signals(df).collect()}
    assert got["a"] == (1, Decimal("6000.00"), False)
    assert got["b"] == (2, Decimal("10000.00"), True)       # 300 s back is inside
    assert got["c"] == (2, Decimal("2.00"), False)          # 301 s back is outside; same second peer in
    assert got["d"] == (2, Decimal("2.00"), False)
    assert got["e"][0] == 1
    plain = {r.transaction_id: (r.txn_count_5min, r.txn_sum_5min, r.velocity_flag)
             for r in velocity_by_self_join(df).collect()}
    assert plain == got


def test_single_row_std_is_not_an_outlier(spark):
    df = rows(spark, [("a", "x", Decimal("100"), "USD", T0), ("b", "y", Decimal("5"), "USD", T0),
                      ("c", "y", Decimal("5"), "USD", T0)])
    out = {r.transaction_id: r for r in scoring.amount_outliers(df).collect()}
    assert out["a"].amount_outlier_flag is False and out["a"].std_amount is None
    assert out["b"].amount_outlier_flag is False and out["b"].std_amount == 0.0


def test_outlier_needs_more_than_three_sigma(spark):
    data = [(f"n{i}", "x", Decimal("10"), "USD", T0) for i in range(20)] + [("big", "x", Decimal("1000"), "USD", T0)]
    out = {r.transaction_id: r.amount_outlier_flag for r in scoring.amount_outliers(rows(spark, data)).collect()}
    assert out["big"] is True and not any(v for k, v in out.items() if k != "big")


def test_reconcile_tolerance_and_null_keys(spark):
    s = rows(spark, [("a", "x", Decimal("10.00"), "USD", T0), ("b", "x", Decimal("10.00"), "USD", T0),
                     (None, "x", Decimal("1"), "USD", T0), ("s", "x", Decimal("1"), "USD", T0)])
    b = rows(spark, [("a", "x", Decimal("10.01"), "USD", T0), ("b", "x", Decimal("10.02"), "USD", T0),
                     (None, "x", Decimal("1"), "USD", T0), ("t", "x", Decimal("1"), "USD", T0)])
    got = {r.transaction_id: r.discrepancy_type for r in reconcile.reconcile(s, b).collect()}
    assert got == {"a": "MATCH", "b": "AMOUNT_MISMATCH", "s": "MISSING_IN_BATCH", "t": "MISSING_IN_STREAM"}
    swapped = {r.transaction_id: r.discrepancy_type for r in reconcile.reconcile(b, s).collect()}
    assert swapped["s"] == "MISSING_IN_STREAM" and swapped["t"] == "MISSING_IN_BATCH"


def test_dedup_tie_break_is_deterministic(spark):
    sch = "transaction_id string, v string, ingest_ts timestamp_ntz, updated_at timestamp_ntz"
    data = [("k", "p", T0, T0), ("k", "q", T0, T0), ("k", "r", T0 - dt.timedelta(1), T0)]
    a = quality.dedup_latest(spark.createDataFrame(data, sch)).collect()
    b = quality.dedup_latest(spark.createDataFrame(list(reversed(data)), sch).repartition(3)).collect()
    assert len(a) == 1 and a[0].v == b[0].v and a[0].v in ("p", "q")


def test_pan_token_and_mask(spark):
    df = spark.createDataFrame([("4111111111111111",), ("12",), (None,), ("tok_abc_1111",), ("[REDACTED]",)],
                               "pan string")
    got = [r.t for r in df.select(pan_token(F.col("pan"), TEST_SALT).alias("t")).collect()]
    import hashlib
    h = hashlib.sha256(("4111111111111111" + TEST_SALT).encode()).hexdigest()[:24]
    assert got[0] == f"tok_{h}_1111"
    assert got[1].endswith("_12") and got[2] is None
    assert got[3] == "tok_abc_1111" and got[4] == "[REDACTED]"
    assert df.select(mask_pan(F.col("pan"))).first()[0] == "************1111"


def test_free_text_redaction(spark):
    text = "card 4111111111111111, id 12345678901234567890, short 123456789012, x1234567890123y"
    out = spark.createDataFrame([(text,)], "t string").select(redact_text(F.col("t"))).first()[0]
    assert "************1111" in out and "12345678901234567890" in out
    assert "123456789012" in out and "x************0123y" in out


@pytest.mark.parametrize("num,den,scale,factor,expected", [
    (1, 8, 2, 1, 0.13), (1, 3, 3, 100, 33.333), (2, 3, 3, 100, 66.667), (-1, 8, 2, 1, -0.13),
    (0, 5, 3, 100, 0.0), (5, 0, 2, 1, None), (12345, 100000, 3, 100, 12.345)])
def test_round_ratio_half_up(spark, num, den, scale, factor, expected):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    got = df.select(round_ratio(F.col("n"), F.col("d"), scale, factor)).first()[0]
    assert got == expected


def test_serving_contract_fails_on_null(spark):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    from ledgerline.operators.contract import require_not_null
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    ok = require_not_null(df.filter("k IS NOT NULL"), ["k"], "t")
    assert ok.count() == 1
    with pytest.raises((PySparkException, Py4JJavaError, Exception)):
        require_not_null(df, ["k"], "t").collect()


def test_routing_partitions_the_input(spark):
    from small_tables import SF_SMALL
    from ledgerline.plans.registry import envelopes
    from ledgerline.streaming.envelope import decode_envelope, route
    env = envelopes(spark, SF_SMALL)
    valid, dead = route(decode_envelope(env))
    assert valid.count() + dead.count() == env.count()
    assert valid.filter(~F.col("card_number").startswith("tok_") & (F.col("card_number") != "[REDACTED]")).count() == 0
    reasons = {r[0] for r in dead.select("reason").distinct().collect()}
    assert reasons == {"DECODE_FAILED", "SCHEMA_VALIDATION_FAILED"}
    assert dead.filter(F.col("event_redacted").contains('"card_number":"4')).count() == 0


def test_contract_enforcement_lists_all_offenders(spark):
    from small_tables import SF_SMALL
    from ledgerline.operators.contract import SchemaCompatibilityError, conformance, enforce, normalize_type
    from ledgerline.sources import fixtures as fx
    df = fx.txn_raw(spark, SF_SMALL).drop("currency")
    report = {r.field: r for r in conformance(spark, df).collect()}
    assert report["currency"].present is False and report["currency"].required is True
    assert report["event_id"].compatible is True           # int -> bigint is a widening
    assert report["updated_at"].compatible is False        # string expected, timestamp found
    assert report["amount"].cast_failures == 0 and report["transaction_id"].nulls > 0
    with pytest.raises(SchemaCompatibilityError) as err:
        enforce(conformance(spark, df))
    assert "currency" in str(err.value) and "updated_at" in str(err.value)
    assert normalize_type(["null", {"type": "long", "logicalType": "timestamp-micros"}]) == "timestamp"
    assert normalize_type({"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 3}) == "decimal(9,3)"


def test_cluster_conf_sizes_partitions():
    from ledgerline.runtime import cluster_conf
    big = cluster_conf(100 * 1024 ** 4, executor_cores=8000, executor_memory_gb=32)
    # 256 MB each would be 409,600; more than max_partitions are not planned
    assert int(big["spark.sql.shuffle.partitions"]) == 50_000
    mid = cluster_conf(10 * 1024 ** 4, executor_cores=800, executor_memory_gb=32)
    assert int(mid["spark.sql.shuffle.partitions"]) == 10 * 1024 ** 4 // (256 * 1024 ** 2)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1024 ** 2, executor_cores=8, executor_memory_gb=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
