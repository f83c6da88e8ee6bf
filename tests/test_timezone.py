"""Results do not depend on the session time zone (NTZ data, zone-free literals)."""

import pytest

import __spark_entry__ as E
from small_tables import SF_SMALL
from tools.check_oracle import digest

ZONE_SENSITIVE = ["velocity_signals", "trailing_30d_outliers", "hourly_fraud_kpis", "fraud_alerts",
                  "history_as_of", "incremental_extract", "incremental_watermark", "upsert_merge",
                  "recon_discrepancies", "scan_merge_schema", "batch_features", "kpi_fraud_trend",
                  "scan_json_raw", "stream_decode"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_same_result_in_another_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(E.oracle_sql()[name])
    assert digest(df.columns, rows)[0] == digest(rel.columns, rel.fetchall())[0]
