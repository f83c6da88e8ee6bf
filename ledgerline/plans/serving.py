"""The serving tables, their shapes, checks and loads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions.timefn import ts_literal
from ledgerline.operators.contract import require_not_null
from ledgerline.sinks.writers import write_serving

TABLES: dict[str, T.StructType] = {
    "fraud_alerts": schemas.FRAUD_ALERTS,
    "daily_fraud_kpis": schemas.DAILY_KPIS,
    "reconciliation_discrepancies": schemas.DISCREPANCIES,
    "dim_merchant_category": schemas.DIM_MERCHANT_SERVING,
    "dim_geo_risk": schemas.DIM_GEO_SERVING,
}
#: Fixed defaults of columns that a load leaves empty; times of loading and detection default to the load's own.
DEFAULTS = {("reconciliation_discrepancies", "resolved"): False, ("dim_geo_risk", "fatf_watchlist"): False}
LOAD_TIMES = {("fraud_alerts", "loaded_at"), ("daily_fraud_kpis", "loaded_at"), ("reconciliation_discrepancies", "detected_at")}


def shaped(df: DataFrame, table: str, loaded_at: dt.datetime) -> DataFrame:
    """``df`` in the columns, order and types of a serving table.

    Missing columns and nulls take the table's defaults; a null that is left in
    a NOT NULL column fails the load instead of losing the row.
    """
    cols = []
    for f in TABLES[table].fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if (table, f.name) in DEFAULTS:
            value = F.coalesce(value, F.lit(DEFAULTS[table, f.name]))
        elif (table, f.name) in LOAD_TIMES:
            value = F.coalesce(value, ts_literal(loaded_at))
        cols.append(value.cast(f.dataType).alias(f.name))
    return require_not_null(df.select(*cols), [f.name for f in TABLES[table].fields if not f.nullable], table)


def jdbc_sink(url: str, properties: dict[str, str], mode: str = "append") -> Callable[[DataFrame, str], None]:
    """Loads a shaped table over JDBC; dimensions are small and replaced whole."""
    def write(df: DataFrame, table: str) -> None:
        write_serving(df, url, table, properties, "overwrite" if table.startswith("dim_") else mode)
    return write


def load_all(frames: dict[str, DataFrame], sink: Callable[[DataFrame, str], None], loaded_at: dt.datetime) -> list[str]:
    """Shape, check and load every serving table for which there are rows to load."""
    unknown = set(frames) - set(TABLES)
    if unknown:
        raise ValueError(f"no such serving table: {sorted(unknown)}")
    for table in TABLES:
        if table in frames:
            sink(shaped(frames[table], table, loaded_at), table)
    return [t for t in TABLES if t in frames]
