"""The seven report queries as Spark SQL over registered views.

For users who run the reports as SQL text: register the tables as views,
then ``run_report(spark, "k1", as_of)``.  ``current_date`` / ``GETDATE()``
of the original statements become the explicit run date ``as_of`` (whole
days, inclusive), and the accuracy report's denominator is all
transactions of the day.  Catalyst plans these exactly like the DataFrame
versions in ``operators.kpis`` (equal results are tested).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

VIEWS = ("gold_transactions", "fraud_alerts", "reconciliation_discrepancies", "dim_geo_risk")


def _pct(num: str, den: str, scale: int) -> str:
    """round(num * 100 / den, scale) HALF_UP on integers (see functions.numeric)."""
    p = 10 ** scale
    q = f"((abs({num}) * {200 * p} + {den}) div (2 * {den}))"
    return f"(CASE WHEN {den} = 0 THEN NULL ELSE (CASE WHEN {num} < 0 THEN -{q} ELSE {q} END) / {float(p)}D END)"


REPORT_SQL: dict[str, str] = {
    # 1. daily fraud-rate trend, 31 days up to the run date
    "k1": f"""
SELECT txn_date, region, count(*) AS txn_volume,
       count_if(fraud_alert) AS flagged_txn_count,
       {_pct('count_if(fraud_alert)', 'count(*)', 3)} AS fraud_rate_pct
FROM gold_transactions
WHERE txn_date BETWEEN date_sub(DATE'{{as_of}}', 30) AND DATE'{{as_of}}'
GROUP BY txn_date, region
ORDER BY txn_date DESC, region""",
    # 2. top 25 flagged accounts by exposure, last 7 days
    "k2": """
SELECT account_id, count(*) AS flagged_txn_count,
       CAST(sum(amount) AS DECIMAL(20,2)) AS total_exposure_amount,
       max(CAST(fraud_risk_score AS DOUBLE)) AS max_risk_score
FROM fraud_alerts
WHERE txn_date BETWEEN date_sub(DATE'{as_of}', 7) AND DATE'{as_of}' AND fraud_alert
GROUP BY account_id
ORDER BY total_exposure_amount DESC, account_id
LIMIT 25""",
    # 3. geo-risk exposure of flagged transactions
    "k3": """
WITH exposed AS (
  SELECT country_code, count_if(fraud_alert) AS flagged_txn_count,
         CAST(sum(amount) FILTER (WHERE fraud_alert) AS DECIMAL(20,2)) AS flagged_amount_total
  FROM fraud_alerts GROUP BY country_code),
countries AS (
  SELECT country_code, min(struct(country_name, fatf_watchlist)) AS c FROM dim_geo_risk GROUP BY country_code)
SELECT country_code, c.country_name, c.fatf_watchlist, flagged_txn_count, flagged_amount_total
FROM exposed JOIN countries USING (country_code)
WHERE flagged_txn_count > 0
ORDER BY flagged_amount_total DESC, country_code""",
    # 4. channel breakdown of yesterday
    "k4": f"""
SELECT channel, count(*) AS txn_volume, count_if(fraud_alert) AS flagged_count,
       {_pct('sum(CAST(round(fraud_risk_score * 10000) AS BIGINT))', 'count(fraud_risk_score) * 1000000', 4)}
         AS avg_risk_score
FROM gold_transactions
WHERE txn_date = date_sub(DATE'{{as_of}}', 1)
GROUP BY channel
ORDER BY flagged_count DESC""",
    # 5. unresolved discrepancies of the last day
    "k5": """
SELECT discrepancy_type, count(*) AS discrepancy_count,
       CAST(sum(abs(coalesce(stream_amount, 0) - coalesce(batch_amount, 0))) AS DECIMAL(20,2))
         AS total_variance_amount
FROM reconciliation_discrepancies
WHERE NOT resolved AND txn_date BETWEEN date_sub(DATE'{as_of}', 1) AND DATE'{as_of}'
GROUP BY discrepancy_type
ORDER BY discrepancy_count DESC""",
    # 6. reconciliation accuracy of yesterday (one aggregation, no join of scalars)
    "k6": f"""
SELECT total_txns, mismatch_count,
       {_pct('total_txns - mismatch_count', 'total_txns', 2)} AS reconciliation_accuracy_pct
FROM (SELECT count_if(src = 'g') AS total_txns, count_if(src = 'd') AS mismatch_count
      FROM (SELECT 'g' AS src FROM gold_transactions WHERE txn_date = date_sub(DATE'{{as_of}}', 1)
            UNION ALL
            SELECT 'd' AS src FROM reconciliation_discrepancies WHERE txn_date = date_sub(DATE'{{as_of}}', 1)))""",
    # 7. high-risk MCC monitor, look-back of {days} days ending yesterday
    "k7": """
SELECT account_id, mcc_code, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount,
       bool_or(coalesce(velocity_flag, false)) AS any_velocity_flag
FROM gold_transactions
WHERE high_risk_mcc_flag
  AND txn_date BETWEEN date_sub(DATE'{as_of}', {days}) AND date_sub(DATE'{as_of}', 1)
GROUP BY account_id, mcc_code
HAVING count(*) > 3
ORDER BY total_amount DESC""",
}


def register_views(gold: DataFrame, alerts: DataFrame, discrepancies: DataFrame, dim_geo: DataFrame) -> None:
    for name, df in zip(VIEWS, (gold, alerts, discrepancies, dim_geo)):
        df.createOrReplaceTempView(name)


def run_report(spark: SparkSession, name: str, as_of: dt.date, days: int = 1) -> DataFrame:
    return spark.sql(REPORT_SQL[name].format(as_of=as_of.isoformat(), days=days))
