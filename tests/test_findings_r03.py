"""The findings of the third review round."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import incremental, quality, scoring
from ledgerline.operators.velocity import CELL, attach, per_second, trailing, trailing_rows, velocity_columns
from ledgerline.params import RiskParams
from ledgerline.plans import medallion, registry
from ledgerline.sources import fixtures as fx

DAY = dt.date(2024, 1, 30)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def write_tables(spark, root):
    """Eight customers, the events of six hours."""
    spark.range(2).selectExpr("int(id) AS r_regionkey", "'ASIA' AS r_name").write.parquet(f"{root}/region.parquet")
    spark.range(2).selectExpr("int(id) AS n_nationkey", "int(id) AS n_regionkey").write.parquet(f"{root}/nation.parquet")
    spark.range(8).selectExpr("id AS c_custkey", "int(id % 2) AS c_nationkey", "'x' AS c_name").write.parquet(f"{root}/customer.parquet")
    spark.range(600).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-30 00:00:00' + make_dt_interval(0, 0, 0, id * 36) AS ts", "id % 9 AS user_id",
        "'click' AS event_type", "double(id % 50) AS value", "'' AS props").write.parquet(f"{root}/events.parquet")
    return str(root)


def test_dq_gate_counts_the_keys_of_every_day(spark):
    gold = spark.createDataFrame([("a", DAY), (None, DAY), ("b", dt.date(2024, 1, 2))], "transaction_id string, txn_date date")
    rec = spark.createDataFrame(
        [("a", "MATCH", DAY), ("b", "MATCH", dt.date(2024, 1, 2)), ("c", "MISSING_IN_BATCH", dt.date(2024, 1, 2)), ("d", "MISSING_IN_STREAM", None)],
        "transaction_id string, discrepancy_type string, txn_date date")
    got = quality.dq_gate(gold, rec, DAY).collect()[0]
    assert (got["row_count"], got["null_ids"]) == (2, 1)
    assert got["recon_accuracy_pct"] == 50.0 and not got["recon_ok"]


def odd_rows(spark):
    """Repeated seconds, window ends, cell ends, missing accounts, times, ids and amounts, a repeated row."""
    at = dt.datetime(2024, 1, 1, 0, 59, 0)
    seconds = [0, 0, 1, 59, 60, 299, 300, 301, 359, 360, 361, 3600, 3660, 3661, 3900]
    rows = [(f"t{a}{i}", a, Decimal(i % 4 * 700), at + dt.timedelta(seconds=s, microseconds=i)) for a in ("x", "y", None) for i, s in enumerate(seconds)]
    rows += [("n1", "x", Decimal(5), None), ("n2", "x", Decimal(6), None), ("n3", None, Decimal(7), None), (None, "x", Decimal(9), at), ("n4", "y", None, at)]
    return spark.createDataFrame([*rows, rows[3]], "transaction_id string, account_id string, amount decimal(18,2), transaction_ts timestamp_ntz")


def test_windows_over_rows_equal_those_joined_back(spark):
    t, p = odd_rows(spark), RiskParams()
    want = velocity_columns(attach(t, trailing(per_second(t), p.velocity_window_s, ["n_id", "s_amt"])), p)
    for cell_s in (None, 300, 7200):
        got = velocity_columns(trailing_rows(t, p.velocity_window_s, cell_s=cell_s).drop(CELL), p)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_statistics_reach_every_hour_of_an_account(spark):
    t = odd_rows(spark)
    spread = {(r["_a"], r["_c"]): (r["n_amt"], r["s_amt"]) for r in scoring.spread_stats(t).collect()}
    whole = {r["account_id"]: (r["n_amt"], r["s_amt"]) for r in scoring.account_stats(t).collect()}
    hours = {(r[0], r[1]) for r in t.select("account_id", scoring.stats_cell(t)).collect() if r[0]}
    assert spread == {k: whole[k[0]] for k in hours}


def test_scoring_shuffles_rows_once(spark, tmp_path):
    """the rows pass one shuffle, by account and cell, and nothing is joined back by second."""
    p = plan(registry.gold(spark, write_tables(spark, tmp_path)))
    assert len(re.findall(r"Exchange hashpartitioning\(account_id#\d+, _cell#\d+", p)) == 1
    assert not re.search(r"Exchange hashpartitioning\([^)]*_sec#", p)


def test_events_meet_customers_of_known_size(spark, tmp_path):
    """the customer side must not count as the product of customer, nation and region."""
    sf = write_tables(spark, tmp_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        p = plan(fx.txn(spark, sf).select("event_id", "country_code"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in p
    assert fx.txn(spark, sf).count() == len([i for i in range(600) if i % 9 < 8])


def test_discrepancy_audit_scores_nothing(spark, tmp_path, monkeypatch):
    """reconciliation compares two tables; Gold has no part in it."""
    def no_gold(*_):
        raise AssertionError("Gold was asked for")
    monkeypatch.setattr(registry, "gold", no_gold)
    got = registry.REGISTRY["kpi_discrepancy_audit"](spark, write_tables(spark, tmp_path)).collect()
    assert {r["discrepancy_type"] for r in got} == {"MISSING_IN_BATCH", "MISSING_IN_STREAM", "AMOUNT_MISMATCH"}


def test_silver_looks_for_the_latest_version_once(spark, tmp_path, monkeypatch):
    """one shuffle by id in the plan, none more in the upsert; the table is the same."""
    sf = write_tables(spark, tmp_path / "in")
    bronze, dims = registry.bronze(spark, sf), registry._dims(spark)
    silver, _ = medallion.silver(bronze, *dims)
    assert len(re.findall(r"Exchange hashpartitioning\(transaction_id#", plan(silver))) == 1

    def again(*_):
        raise AssertionError("the latest version was looked for twice")
    monkeypatch.setattr(incremental, "dedup_latest", again)
    path = str(tmp_path / "silver")
    done = medallion.run_silver(spark, bronze, *dims, path, exists=False)
    stored = spark.read.schema(silver.schema).parquet(path).select(*silver.columns)
    assert done["silver_rows_published"] == silver.count() == stored.count()
    assert sorted(map(str, stored.collect())) == sorted(map(str, silver.collect()))
    assert stored.groupBy("transaction_id").count().filter(F.col("count") > 1).isEmpty()
