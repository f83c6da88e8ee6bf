"""Inputs outside the project's own event form: offsets, broken lines, null partitions, repeated dimension keys."""

import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.timefn import parse_iso_utc
from ledgerline.operators import contract, enrich, incremental, ingest
from ledgerline.sources.scans import scan_json
from ledgerline.streaming.envelope import b64, decode_envelope, routed


@pytest.mark.parametrize("text, want", [
    ("2024-01-01T10:00:00.123456+00:00", dt.datetime(2024, 1, 1, 10, 0, 0, 123456)),
    ("2024-01-01T10:00:00+00:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00Z", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01 10:00:00", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00.5-05:30", dt.datetime(2024, 1, 1, 15, 30, 0, 500000)),
    ("2024-01-01T01:00:00+0200", dt.datetime(2023, 12, 31, 23)),
    ("2024-13-01T10:00:00", None), ("yesterday", None), ("", None), (None, None)])
def test_parse_iso_utc(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(parse_iso_utc("t")).first()[0]
    assert got == want


STAMPS = ["2024-01-01T10:00:00.123456+00:00", "2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00Z", "2024-01-01T12:00:00+02:00"]


def _event(stamp, n):
    return {"transaction_id": f"t{n}", "account_id": "a", "card_number": "4111111111111111", "amount": 10.5, "currency": "USD", "transaction_ts": stamp}


def test_bronze_from_json_keeps_every_event_and_no_card_number(spark, tmp_path):
    lines = [json.dumps(_event(s, n)) for n, s in enumerate(STAMPS)]
    broken = [lines[0][:-20], json.dumps(_event(None, 8))[:95], '{"card_number": "4111 1111 1111 1111", "amount"', json.dumps(_event("no date", 9))]
    (tmp_path / "in.json").write_text("\n".join(lines + broken))
    raw = scan_json(spark, str(tmp_path / "in.json"))
    assert raw.where("_corrupt_record is null and transaction_ts is not null").count() == len(STAMPS)
    assert raw.where("_corrupt_record is not null").count() == len(broken)
    valid, quarantine = ingest.ingest_bronze(raw, "salt", dt.datetime(2024, 1, 2), source_file="f")
    for rows in (valid.collect(), quarantine.collect()):
        for r in rows:
            for c, v in r.asDict().items():
                if not c.endswith("sha256") and c != "card_number_token":
                    assert not re.search(r"[0-9](?:[ -]?[0-9]){8,}", str(v)) or isinstance(v, (dt.datetime, dt.date)) or c == "batch_id", (c, v)


def test_stream_accepts_offsets(spark):
    rows = [(json.dumps(_event(s, n)),) for n, s in enumerate(STAMPS)]
    env = spark.createDataFrame(rows, "j string").select(b64(F.col("j")).alias("data"), F.lit("a").alias("partition_key"))
    out = routed(decode_envelope(env)).collect()
    assert {r["route"] for r in out} == {"valid"}
    assert {r["transaction_ts"].replace(microsecond=0) for r in out} == {dt.datetime(2024, 1, 1, 10)}


def test_contract_names_every_finding(spark):
    fields = [{"name": f"f{i}", "type": "long"} for i in range(1_500)]
    report = spark.createDataFrame([(f["name"], True, False, "bigint", None, False) for f in fields],
                                   "field string, required boolean, present boolean, expected string, actual string, compatible boolean")
    with pytest.raises(contract.SchemaCompatibilityError) as e:
        contract.enforce(report)
    assert all(f"'f{i}'" in str(e.value) for i in range(1_500))


def _table(spark, path):
    kind = "id string, p string, updated_at timestamp, v int"
    return sorted((r["id"], r["p"], r["v"]) for r in spark.read.schema(kind).parquet(path).collect())


def test_upsert_null_typed_and_escaped_partitions(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "id string, p string, updated_at timestamp, v int"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    first = [("a", None, at(1), 1), ("b", None, at(1), 1), ("c", "x", at(1), 1), ("d", "01", at(1), 1), ("e", "02", at(1), 1), ("f", "u/v w:%", at(1), 1)]
    incremental.upsert(spark, path, spark.createDataFrame(first, kind), "p", keys=("id",), exists=False)
    # in the null partition, out of it, into it, and zero-padded
    incremental.upsert(spark, path, spark.createDataFrame([("a", None, at(2), 2), ("c", "x", at(2), 2)], kind), "p", keys=("id",))
    assert _table(spark, path) == sorted([("a", None, 2), ("b", None, 1), ("c", "x", 2), ("d", "01", 1), ("e", "02", 1), ("f", "u/v w:%", 1)], key=lambda r: (r[0],))
    incremental.upsert(spark, path, spark.createDataFrame([("a", "01", at(3), 3), ("d", "02", at(3), 3), ("f", "x", at(3), 3)], kind), "p", keys=("id",))
    incremental.upsert(spark, path, spark.createDataFrame([("b", None, at(4), 4)], kind), "p", keys=("id",))
    assert _table(spark, path) == sorted([("a", "01", 3), ("b", None, 4), ("c", "x", 2), ("d", "02", 3), ("e", "02", 1), ("f", "x", 3)], key=lambda r: (r[0],))


def test_repeated_dimension_keys_do_not_multiply(spark):
    facts = spark.createDataFrame([("a", "US"), ("a", "FR"), (None, "US")], "account_id string, country_code string")
    dim = spark.createDataFrame([("a", "US"), ("a", "US"), ("a", "FR")], "account_id string, home_country string")
    assert enrich.geo_mismatch(facts, dim).count() == 3


def test_gold_rerun_leaves_no_stale_partitions(spark, tmp_path):
    from ledgerline.sinks.writers import replace_days
    path, day = str(tmp_path / "g"), [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    rows = lambda *r: spark.createDataFrame(list(r), "txn_date date, region string, v int")
    replace_days(spark, rows((day[0], "a/b", 1), (day[0], None, 2), (day[1], "EU", 3)), path, ["txn_date", "region"], day)
    replace_days(spark, rows((day[0], "a/b", 4)), path, ["txn_date", "region"], day[:1])
    got = {(r["txn_date"], r["region"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {(day[0], "a/b", 4), (day[1], "EU", 3)}
    replace_days(spark, rows().where("false"), path, ["txn_date", "region"], day[1:])
    assert {r["v"] for r in spark.read.parquet(path).collect()} == {4}


def test_long_windows_by_events_equal_the_sliding_frame(spark):
    import random
    from ledgerline.operators.velocity import SEC, trailing, trailing_by_events
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), None if n % 50 == 0 else r.randint(0, 400_000), r.randint(1, 3), r.choice([None, 5, 7])) for n in range(400)]
    rows = [(k, s, n, v) for (k, s), (n, v) in {(k, s): (n, v) for k, s, n, v in rows}.items()]
    ps = spark.createDataFrame(rows, f"account_id string, {SEC} long, n_id long, s_amt long")
    for window, excl in ((90_000, False), (90_000, True), (100, False)):
        fast = trailing_by_events(ps, window, ["n_id", "s_amt"], excl, cell_s=50_000)
        slow = trailing(ps, window, ["n_id", "s_amt"], excl)
        key = lambda x: str(tuple(x))
        assert sorted(map(tuple, fast.collect()), key=key) == sorted(map(tuple, slow.collect()), key=key)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    # running sums only: no frame slides over the window's seconds
    assert plan.count("RangeFrame") == plan.count("RangeFrame, unboundedpreceding$()") > 0


def test_scoring_does_not_overflow(spark):
    from decimal import Decimal
    from statistics import mean, stdev
    from ledgerline.operators import scoring
    top = Decimal("9999999999999999.99")
    amounts = [Decimal(f"{n % 7}.{n % 100:02d}") for n in range(300)] + [top, -top]
    rows = [("a", x) for x in amounts] + [("b", top)] * 150 + [("c", top)] * 149 + [("c", top - Decimal("0.01"))] + [("d", None), ("e", Decimal("5.00"))]
    df = spark.createDataFrame(rows, "account_id string, amount decimal(18,2)")
    got = {r["account_id"]: r for r in scoring.stats_columns(scoring.account_stats(df)).collect()}
    assert abs(got["a"]["std_amount"] / float(stdev(amounts)) - 1) < 1e-12
    assert abs(got["a"]["avg_amount"] - float(mean(amounts))) < 1e-3
    assert got["b"]["std_amount"] == 0.0 and abs(got["b"]["avg_amount"] / float(top) - 1) < 1e-15
    assert got["c"]["std_amount"] == round(float(stdev([Decimal("0.01")] * 149 + [Decimal(0)])), 4)
    assert got["d"]["std_amount"] is None and got["e"]["std_amount"] is None
    out = scoring.amount_outliers(df).where("amount_outlier_flag").collect()
    assert sorted((r["account_id"], r["amount"]) for r in out) == [("a", -top), ("a", top), ("c", top - Decimal("0.01"))]
