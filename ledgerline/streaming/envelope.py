"""Event envelopes: base64 JSON payload plus routing key.

The column functions here work unchanged on batch and streaming
DataFrames; the stream job and its batch twin share them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.functions.pan import redact_pan, was_redacted
from ledgerline.functions.timefn import parse_iso_utc
from ledgerline.operators.contract import STREAM_REQUIRED
from ledgerline.sources.scans import iso_as_text

JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Fixed routing reasons of the dead-letter table.
DECODE_FAILED = "DECODE_FAILED"
SCHEMA_VALIDATION_FAILED = "SCHEMA_VALIDATION_FAILED"
# Ours: a complete event that arrives after its time has passed.
LATE_ARRIVAL = "LATE_ARRIVAL"

_EVENT_FIELDS = [f.name for f in schemas.RAW_EVENT.fields]
_STAMPS = {f.name for f in schemas.RAW_EVENT.fields if f.dataType.typeName() == "timestamp_ntz"}


def event_json(df: DataFrame, fields: Sequence[str] = tuple(_EVENT_FIELDS)) -> Column:
    """Canonical JSON text of an event: fixed key order, NULL keys omitted,
    decimals as plain numbers, timestamps ISO-8601 with microseconds.

    One native ``to_json`` (escaping included); timestamps are formatted
    first so the text does not depend on JSON writer options.
    """
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    cols = []
    for name in fields:
        if name not in types:
            continue
        c = F.col(name)
        if types[name] in ("timestamp_ntz", "timestamp"):
            c = F.date_format(c, JSON_TS)
        cols.append(c.alias(name))
    return F.to_json(F.struct(*cols))


def b64(text: Column) -> Column:
    """Standard base64 on one line (Spark's MIME form inserts CRLF every 76 chars)."""
    return F.regexp_replace(F.base64(F.encode(text, "UTF-8")), r"[\r\n]", "")


def encode_envelope(df: DataFrame) -> DataFrame:
    """Producer side: one envelope per event, keyed by account."""
    return df.select(b64(event_json(df)).alias("data"), F.col("account_id").alias("partition_key"))


def decode_envelope(env: DataFrame) -> DataFrame:
    """base64 -> UTF-8 JSON -> typed event; undecodable rows are marked.

    The parses run inside one-row ``inline`` generators, first of the payload,
    then of its timestamps.  Filters on the decoded fields (routing) then stay
    above the generators, so each payload and each timestamp is parsed exactly
    once per row; with a plain projection the optimizer would substitute the
    parses into every pushed-down predicate.
    """
    payload = F.try_to_binary(F.col("data"), F.lit("base64")).cast("string")
    d = env.select("partition_key", "data", payload.alias("payload"))
    parsed = F.struct(
        F.json_object_keys("payload").isNull().alias("decode_error"),
        F.from_json("payload", iso_as_text(schemas.RAW_EVENT)).alias("_e"))
    d = d.select("partition_key", "data", F.inline(F.array(parsed)))
    times = F.struct(*[parse_iso_utc(f"_e.{n}").alias(f"_t_{n}") for n in sorted(_STAMPS)])
    d = d.select("partition_key", "data", "decode_error", "_e", F.inline(F.array(times)))
    bad = F.col("decode_error")
    return d.select(
        "partition_key",
        F.sha2(F.col("data"), 256).alias("payload_sha256"),
        bad.alias("decode_error"),
        *[F.when(~bad, F.col(f"_t_{n}") if n in _STAMPS else F.col(f"_e.{n}")).alias(n) for n in _EVENT_FIELDS],
    )


def redact(df: DataFrame) -> DataFrame:
    """Raw card numbers never pass the consumer."""
    return (df.withColumn("redacted", was_redacted(F.col("card_number")))
            .withColumn("card_number", redact_pan(F.col("card_number"))))


def flag_required(df: DataFrame, required: Sequence[str] = STREAM_REQUIRED, late: Column | None = None) -> DataFrame:
    """Missing (absent or NULL) required fields and the routing reason.

    ``late`` marks events that are behind the stream's time (S8)."""
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in required]))
    reason = (F.when(F.col("decode_error"), F.lit(DECODE_FAILED))
              .when(F.size(missing) > 0, F.lit(SCHEMA_VALIDATION_FAILED)))
    if late is not None:
        reason = reason.when(late, F.lit(LATE_ARRIVAL))
    return df.withColumn("missing_fields", missing).withColumn("reason", reason)


VALID_COLUMNS = ["partition_key", "payload_sha256", *_EVENT_FIELDS, "redacted"]
DEAD_COLUMNS = ["partition_key", "reason", "missing_fields", "payload_sha256", "event_redacted"]


def routed(decoded: DataFrame, late: Column | None = None) -> DataFrame:
    """Decode -> redact -> validate in one projection, with a ``route``
    column (``valid`` / ``dead``) so one write can serve both sinks."""
    checked = flag_required(redact(decoded), late=late)
    return checked.select(
        *checked.columns,
        F.when(F.col("reason").isNull(), F.lit("valid")).otherwise(F.lit("dead")).alias("route"),
        F.when(F.col("reason").isNotNull() & ~F.col("decode_error"), event_json(checked))
        .alias("event_redacted"))


def split_routed(r: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (r.filter(F.col("route") == "valid").select(*VALID_COLUMNS),
            r.filter(F.col("route") == "dead").select(*DEAD_COLUMNS))


def route(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letter) from one plan."""
    return split_routed(routed(decoded))
