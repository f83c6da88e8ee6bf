"""Data-quality rule expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed flag names of the quality rules.
INVALID_AMOUNT = "INVALID_AMOUNT"
MISSING_ACCOUNT = "MISSING_ACCOUNT"
INVALID_CURRENCY = "INVALID_CURRENCY"
MISSING_TIMESTAMP = "MISSING_TIMESTAMP"
CURRENCY_PATTERN = r"^[A-Z]{3}\z"


def dq_flags() -> Column:
    """Array of the failed rule names (empty when the row is clean)."""
    amount, currency = F.col("amount"), F.col("currency")
    return F.array_compact(F.array(
        F.when(amount.isNull() | (amount <= 0), F.lit(INVALID_AMOUNT)),
        F.when(F.col("account_id").isNull(), F.lit(MISSING_ACCOUNT)),
        F.when(currency.isNull() | ~currency.rlike(CURRENCY_PATTERN), F.lit(INVALID_CURRENCY)),
        F.when(F.col("transaction_ts").isNull(), F.lit(MISSING_TIMESTAMP)),
    ))
