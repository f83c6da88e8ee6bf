"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.datetime(1970, 1, 1)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a TIMESTAMP_NTZ column.

    Built from calendar fields, which are zone-free on NTZ values; casting
    to TIMESTAMP first would apply the session zone (and its DST jumps).
    For TIMESTAMP (with zone) columns use ``F.unix_seconds``.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    days = F.datediff(F.to_date(col), F.lit(_EPOCH.date())).cast("long")
    return (days * 86400 + F.hour(col).cast("long") * 3600 + F.minute(col).cast("long") * 60
            + F.second(col).cast("long"))


_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?(?:Z|[+-]\d{2}:?\d{2})?$"
_SECONDS = 19  # characters of date and time up to the whole second


def parse_iso_utc(text: Column | str) -> Column:
    """ISO-8601 text, fraction and offset optional -> TIMESTAMP_NTZ in UTC; NULL if it is none.

    Without an offset the text is taken as UTC.  One pattern match a value: the
    cast reads the local time whatever offset follows, which is then taken off.
    """
    col = F.trim(F.col(text) if isinstance(text, str) else text)
    local = F.when(col.rlike(_ISO), col.try_cast("timestamp_ntz"))
    tail = F.substring(col, _SECONDS + 1, 20)  # fraction and offset
    at = F.greatest(F.instr(tail, "+"), F.instr(tail, "-"))
    number = lambda x: x.try_cast("int")
    minutes = number(F.substr(tail, at + 1, F.lit(2))) * 60 + number(F.right(tail, F.lit(2)))
    east = F.substr(tail, at, F.lit(1)) == "+"
    back = F.when(at > 0, F.when(east, -minutes).otherwise(minutes)).otherwise(F.lit(0))
    return F.timestamp_add("MINUTE", back, local)


def days_before(day: dt.date, n: int) -> dt.date:
    return day - dt.timedelta(days=n)


def ts_literal(value: dt.datetime) -> Column:
    """TIMESTAMP_NTZ literal of a naive wall-clock datetime.

    ``F.lit(datetime)`` builds a zoned TIMESTAMP that shifts by the session
    offset when compared with or cast to NTZ; casting the ISO text is
    zone-free.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
