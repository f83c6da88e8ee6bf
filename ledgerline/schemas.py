"""Explicit schemas: the pipeline never infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
MONEY_TOTAL = T.DecimalType(20, 2)

# Raw transaction event as produced upstream (JSON lines).
RAW_EVENT = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("card_number", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("mcc_code", T.StringType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("transaction_ts", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("device_id", T.StringType()),
])

# Stream envelope: base64 text of the JSON event plus the routing key.
ENVELOPE = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("partition_key", T.StringType()),
])

WATERMARKS = T.StructType([
    T.StructField("source_system", T.StringType()),
    T.StructField("last_processed_ts", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

DIM_MERCHANT = T.StructType([
    T.StructField("mcc_code", T.StringType()),
    T.StructField("mcc_description", T.StringType()),
    T.StructField("risk_tier", T.StringType()),
])

DIM_GEO = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("geo_risk_score", T.DecimalType(4, 3)),
    T.StructField("fatf_watchlist", T.BooleanType()),
])

# Serving-table shapes (types, NOT NULL columns, defaults).
FRAUD_ALERTS = T.StructType([
    T.StructField("transaction_id", T.StringType(), False),
    T.StructField("account_id", T.StringType(), False),
    T.StructField("card_number_token", T.StringType()),
    T.StructField("amount", MONEY, False),
    T.StructField("currency", T.StringType(), False),
    T.StructField("country_code", T.StringType()),
    T.StructField("mcc_code", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("transaction_ts", T.TimestampNTZType(), False),
    T.StructField("txn_date", T.DateType(), False),
    T.StructField("region", T.StringType()),
    T.StructField("fraud_risk_score", T.DecimalType(6, 4), False),
    T.StructField("fraud_alert", T.BooleanType(), False),
    T.StructField("velocity_flag", T.BooleanType()),
    T.StructField("high_risk_mcc_flag", T.BooleanType()),
    T.StructField("amount_outlier_flag", T.BooleanType()),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

DAILY_KPIS = T.StructType([
    T.StructField("txn_date", T.DateType(), False),
    T.StructField("region", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("txn_volume", T.LongType()),
    T.StructField("txn_amount_total", MONEY_TOTAL),
    T.StructField("flagged_txn_count", T.LongType()),
    T.StructField("flagged_exposure_amount", MONEY_TOTAL),
    T.StructField("fraud_rate_pct", T.DecimalType(6, 3)),
    T.StructField("loaded_at", T.TimestampNTZType()),
])

DISCREPANCIES = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("discrepancy_type", T.StringType(), False),
    T.StructField("stream_amount", MONEY),
    T.StructField("batch_amount", MONEY),
    T.StructField("txn_date", T.DateType()),
    T.StructField("detected_at", T.TimestampNTZType()),
    T.StructField("resolved", T.BooleanType()),
    T.StructField("resolution_notes", T.StringType()),
])

# The dimensions as served: keys and defaults as declared.
DIM_MERCHANT_SERVING = T.StructType([
    T.StructField("mcc_code", T.StringType(), False),
    T.StructField("mcc_description", T.StringType()),
    T.StructField("risk_tier", T.StringType()),
])

DIM_GEO_SERVING = T.StructType([
    T.StructField("country_code", T.StringType(), False),
    T.StructField("country_name", T.StringType()),
    T.StructField("geo_risk_score", T.DecimalType(4, 3)),
    T.StructField("fatf_watchlist", T.BooleanType()),
])
