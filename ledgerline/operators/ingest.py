"""Bronze ingestion: tokenise the card number, stamp metadata, quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.pan import pan_token, redact_record
from ledgerline.functions.timefn import ts_literal


def tokenize_pan(df: DataFrame, salt: str, col: str = "card_number",
                 out: str = "card_number_token") -> DataFrame:
    """Add the deterministic PAN token (native SHA-256, stays in codegen)."""
    return df.withColumn(out, pan_token(F.col(col), salt))


def ingest_bronze(raw: DataFrame, salt: str, ingest_ts: dt.datetime | None = None,
                  batch_id: str | None = None,
                  source_file: str | None = None) -> tuple[DataFrame, DataFrame]:
    """raw event -> (valid, quarantine).

    The raw PAN is dropped right after tokenisation so it is never
    persisted; a scan's ``_corrupt_record`` is replaced by its redacted text and
    the line's SHA-256 (``corrupt_sha256``).  ``ingest_ts`` / ``batch_id`` are parameters of the run
    (the batch id is the UTC ``yyyyMMddHHmmss`` of ``ingest_ts``); when
    ``ingest_ts`` is None an existing ``ingest_ts`` column is kept.
    ``source_file`` defaults to the scan's ``_metadata.file_path``.
    Both outputs come from the same lazy plan; callers write them in one
    job each without counting first.
    """
    df = tokenize_pan(raw, salt).drop("card_number")
    if "_corrupt_record" in df.columns:
        df = df.withColumns({"corrupt_sha256": F.sha2("_corrupt_record", 256),
                             "_corrupt_record": redact_record(F.col("_corrupt_record"))})
    if ingest_ts is not None:
        df = df.withColumn("ingest_ts", ts_literal(ingest_ts))
        if batch_id is None:
            batch_id = ingest_ts.strftime("%Y%m%d%H%M%S")
    if "ingest_date" not in df.columns or ingest_ts is not None:
        df = df.withColumn("ingest_date", F.to_date("ingest_ts"))
    df = df.withColumn("batch_id", F.lit(batch_id) if batch_id is not None
                       else F.date_format("ingest_ts", "yyyyMMddHHmmss"))
    src = F.lit(source_file) if source_file is not None else F.col("_metadata.file_path")
    df = df.withColumn("source_file", src)
    valid = df.filter(F.col("transaction_id").isNotNull())
    quarantine = df.filter(F.col("transaction_id").isNull())
    return valid, quarantine
