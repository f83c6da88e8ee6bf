"""The SQL report texts equal the DataFrame report functions."""

import pytest

SF = "/root/testdata/sf0.01"   # the smallest tables leave some reports empty
from ledgerline.operators import kpis
from ledgerline.params import AS_OF
from ledgerline.plans import reports_sql
from ledgerline.plans.registry import alerts, disc, gold
from ledgerline.sources import fixtures as fx
from tools.check_oracle import digest


@pytest.fixture(scope="module")
def views(spark):
    g, a, d, geo = gold(spark, SF), alerts(spark, SF), disc(spark, SF), fx.dim_geo_risk(spark)
    reports_sql.register_views(g, a, d, geo)
    return g, a, d, geo


CASES = {
    "k1": lambda g, a, d, geo: kpis.fraud_trend(g, AS_OF),
    "k2": lambda g, a, d, geo: kpis.top_accounts(a, AS_OF),
    "k3": lambda g, a, d, geo: kpis.geo_exposure(a, geo),
    "k4": lambda g, a, d, geo: kpis.channel_breakdown(g, AS_OF),
    "k5": lambda g, a, d, geo: kpis.discrepancy_audit(d, AS_OF),
    "k6": lambda g, a, d, geo: kpis.recon_accuracy(g, d, AS_OF),
    "k7": lambda g, a, d, geo: kpis.high_risk_mcc(g, AS_OF, days=30),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_sql_report_equals_dataframe_report(spark, views, name):
    want = CASES[name](*views)
    got = reports_sql.run_report(spark, name, AS_OF, days=30)
    assert sorted(got.columns) == sorted(want.columns)
    assert [f.dataType.simpleString() for f in sorted(got.schema.fields, key=lambda f: f.name)] == \
        [f.dataType.simpleString() for f in sorted(want.schema.fields, key=lambda f: f.name)]
    gr, wr = [tuple(r) for r in got.collect()], [tuple(r) for r in want.collect()]
    assert len(gr) == len(wr) > 0
    assert digest(got.columns, gr)[0] == digest(want.columns, wr)[0]
