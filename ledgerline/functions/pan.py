"""Card-number protection: tokenise, redact, mask (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the token format and the redaction marker: tokens are
# "tok_" + 24 hex digits of SHA-256(pan || salt) + "_" + the last four
# characters; redacted card numbers read "[REDACTED]".
TOKEN_PREFIX = "tok_"
REDACTED = "[REDACTED]"
# Masked display keeps the last four digits behind a fixed-width mask.
MASK = "************"
# Free-text card numbers: runs of 13 to 16 ASCII digits.
PAN_RUN = r"(?<![0-9])[0-9]{13,16}(?![0-9])"
PAN_RUN_LAST4 = r"(?<![0-9])[0-9]{9,12}([0-9]{4})(?![0-9])"


def is_protected(pan: Column) -> Column:
    return pan.startswith(TOKEN_PREFIX) | (pan == F.lit(REDACTED))


def pan_token(pan: Column, salt: str | Column) -> Column:
    """``tok_`` + first 24 hex of SHA-256(pan || salt) + ``_`` + last 4.

    Deterministic for a given salt; NULL stays NULL and values that are
    already tokens or redacted pass through unchanged.
    """
    digest = F.sha2(F.concat(pan, F.lit(salt)), 256)  # F.lit leaves a column as it is
    token = F.concat(F.lit(TOKEN_PREFIX), F.substring(digest, 1, 24), F.lit("_"),
                     F.right(pan, F.lit(4)))
    return F.when(pan.isNull() | is_protected(pan), pan).otherwise(token)


def redact_pan(pan: Column) -> Column:
    """Anything that is not a token is replaced by ``[REDACTED]``; NULL passes."""
    return F.when(pan.isNull() | pan.startswith(TOKEN_PREFIX), pan).otherwise(F.lit(REDACTED))


def was_redacted(pan: Column) -> Column:
    return F.coalesce(~pan.startswith(TOKEN_PREFIX), F.lit(False))


def mask_pan(pan: Column) -> Column:
    """Display form: fixed mask plus the last four characters."""
    return F.when(pan.isNull(), pan).otherwise(F.concat(F.lit(MASK), F.right(pan, F.lit(4))))


def redact_text(text: Column) -> Column:
    """Mask every 13-16 digit run in free text, keeping its last four digits."""
    return F.regexp_replace(text, PAN_RUN_LAST4, MASK + "$1")


# A card number in a broken record: the field's value as far as it goes, and
# any run of 9 or more digits with single spaces or dashes between them.
_PAN_FIELD = r'("card_number"\s*:\s*)"?[^",}]*"?'
_LONG_DIGITS = r"[0-9](?:[ -]?[0-9]){8,}"


def redact_record(text: Column) -> Column:
    """A raw record's text without the card number, whole or cut off."""
    return F.regexp_replace(F.regexp_replace(text, _PAN_FIELD, f'$1"{REDACTED}"'), _LONG_DIGITS, REDACTED)


def count_pan_runs(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PAN_RUN)).cast("long")
