"""Data contracts: field presence, type compatibility, value conformance.

A contract is a list of Avro-style fields.  ``conformance`` applies it to
the schema *and* the data: one row per contract field with presence, the
expected and actual types, whether the actual type is the expected one or
a widening of it, and data metrics (rows, nulls, values that do not cast
to the expected type) from a single aggregation over the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.tables import literal_table

# Fixed values of the contract rules: the primitive type map, the widening
# chain int -> bigint -> float -> double, and the two required-field sets
# (5 on the event stream, 8 for the batch contract).
PRIMITIVES = {"string": "string", "double": "double", "long": "bigint", "int": "int",
              "boolean": "boolean", "float": "float"}
NUMERIC_WIDTH = {"int": 1, "bigint": 2, "float": 3, "double": 4}
LOGICAL = {"date": "date", "timestamp-micros": "timestamp", "timestamp-millis": "timestamp",
           "local-timestamp-micros": "timestamp_ntz", "local-timestamp-millis": "timestamp_ntz"}
LOSSY_WIDENINGS = {("bigint", "float"), ("bigint", "double"), ("int", "float")}
STREAM_REQUIRED = ("transaction_id", "account_id", "amount", "currency", "transaction_ts")
CONTRACT_REQUIRED = STREAM_REQUIRED + ("mcc_code", "country_code", "channel")

# The transaction-event contract (Avro field list).
TRANSACTION_CONTRACT: list[dict[str, Any]] = [
    {"name": "transaction_id", "type": "string"},
    {"name": "account_id", "type": "string"},
    {"name": "amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2}},
    {"name": "currency", "type": "string"},
    {"name": "transaction_ts", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
    {"name": "mcc_code", "type": "string"},
    {"name": "country_code", "type": "string"},
    {"name": "channel", "type": "string"},
    {"name": "region", "type": ["null", "string"]},
    {"name": "device_id", "type": ["null", "string"]},
    {"name": "event_id", "type": "int"},
    {"name": "updated_at", "type": ["null", "string"]},
    {"name": "wallet_provider", "type": ["null", "string"]},
]


class SchemaCompatibilityError(Exception):
    """Raised by ``enforce`` when a report holds a breaking finding."""


def normalize_type(avro_type: Any) -> str | None:
    """Avro type (primitive, nullable union, logical type) -> Spark type name."""
    match avro_type:
        case list():
            return next((normalize_type(t) for t in avro_type if t != "null"), None)
        case {"logicalType": "decimal"}:
            return f"decimal({avro_type.get('precision', 10)},{avro_type.get('scale', 0)})"
        case {"logicalType": name} if name in LOGICAL:
            return LOGICAL[name]
        case dict():
            return normalize_type(avro_type.get("type"))
        case str():
            return PRIMITIVES.get(avro_type, avro_type)
    return None


def is_widening(expected: str, actual: str) -> bool:
    """A numeric type read where one of at most its width is expected."""
    return 0 < NUMERIC_WIDTH.get(expected, 0) <= NUMERIC_WIDTH.get(actual, 0)


def contract_rows(contract: Iterable[dict[str, Any]], actual: dict[str, str],
                  required: Sequence[str]) -> list[tuple]:
    rows = []
    for f in contract:
        name = f["name"]
        exp = normalize_type(f["type"])
        act = actual.get(name)
        present = act is not None
        same = present and exp == act
        widen = present and not same and is_widening(exp, act)
        rows.append((name, name in required, present, exp, act, bool(same or widen),
                     bool(widen and (exp, act) in LOSSY_WIDENINGS)))
    return rows


def conformance(spark: SparkSession, df: DataFrame,
                contract: Sequence[dict[str, Any]] = tuple(TRANSACTION_CONTRACT),
                required: Sequence[str] = CONTRACT_REQUIRED) -> DataFrame:
    """V1-V5: one report row per contract field (data scanned once)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    meta = contract_rows(contract, actual, required)
    meta_df = literal_table(spark, meta, T.StructType([
        T.StructField("field", T.StringType()), T.StructField("required", T.BooleanType()),
        T.StructField("present", T.BooleanType()), T.StructField("expected", T.StringType()),
        T.StructField("actual", T.StringType()), T.StructField("compatible", T.BooleanType()),
        T.StructField("lossy_widening", T.BooleanType())]))
    present = [(m[0], m[3]) for m in meta if m[2]]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (name, exp) in enumerate(present):
        c = F.col(name)
        aggs.append(F.count(c).alias(f"_nn{i}"))
        aggs.append(F.count_if(c.isNotNull() & c.try_cast(exp).isNull()).alias(f"_cf{i}") if exp
                    else F.lit(0).alias(f"_cf{i}"))
    m = df.agg(*aggs)
    if present:
        pieces = ", ".join(f"'{n}', _nn{i}, _cf{i}" for i, (n, _) in enumerate(present))
        per = m.selectExpr("_rows", f"stack({len(present)}, {pieces}) AS (field, non_null, cast_failures)")
        per = per.select("field", F.col("_rows").alias("rows"),
                         (F.col("_rows") - F.col("non_null")).alias("nulls"),
                         F.col("cast_failures").cast("long").alias("cast_failures"))
    else:
        per = literal_table(spark, [], T.StructType([
            T.StructField("field", T.StringType()), T.StructField("rows", T.LongType()),
            T.StructField("nulls", T.LongType()), T.StructField("cast_failures", T.LongType())]))
    return meta_df.join(per, "field", "left")


def enforce(report: DataFrame) -> None:
    """Raise ``SchemaCompatibilityError`` listing every breaking finding."""
    bad = report.filter((F.col("required") & ~F.col("present"))
                        | (F.col("present") & ~F.col("compatible")))
    found = [(r["field"], r["expected"], r["actual"]) for r in bad.collect()]  # a row per contract field
    if found:
        raise SchemaCompatibilityError(f"contract violations: {found}")


def align_schema(df: DataFrame, canonical: T.StructType) -> DataFrame:
    """Canonical columns in order (cast, missing as NULL), extras after."""
    have = set(df.columns)
    cols = [(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in canonical.fields]
    extras = [c for c in df.columns if c not in set(canonical.names)]
    return df.select(*cols, *extras)


def require_not_null(df: DataFrame, cols: Sequence[str], table: str) -> DataFrame:
    """V7: NOT NULL columns of a serving table fail the write instead of
    silently dropping or loading bad rows (``raise_error`` is evaluated per
    row inside the projection, so it cannot be pruned away)."""
    out = []
    for c in df.columns:
        if c in cols:
            msg = F.lit(f"{table}.{c} is NOT NULL but a row has NULL")
            out.append(F.when(F.col(c).isNull(), F.raise_error(msg)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
