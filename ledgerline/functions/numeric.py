"""Exact rounding of ratios: integer arithmetic, then one division.

Rounding a floating-point ratio HALF_UP depends on how the engine rounds
the binary value; doing it on integers makes the result the same
everywhere and independent of aggregation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_ratio(num: Column, den: Column, scale: int, factor: int = 1) -> Column:
    """round(num * factor / den, scale) with HALF_UP, NULL when den is 0.

    ``num`` and ``den`` must be integral; the result is a double.
    """
    p = 10 ** scale
    whole = "decimal(38,0)"
    d = F.nullif(den.cast("decimal(22,0)"), F.lit(0).cast("decimal(22,0)"))
    x = (F.abs(num).cast("decimal(30,0)") * F.lit(2 * factor * p).cast("decimal(7,0)")).cast(whole) + d
    q = ((x - F.pmod(x, d * 2)) / (d * 2)).cast(whole)  # exact: a whole quotient
    return F.when(num < 0, -q).otherwise(q).cast("double") / F.lit(float(p))


def avg_of_scaled(values: Column, scale: int) -> tuple[Column, Column]:
    """Aggregates for an exact rounded average of ``scale``-decimal values.

    Returns (sum of values * 10**scale as long, count); combine with
    ``round_ratio(s, n, 0) / 10**scale``.
    """
    ints = F.round(values * F.lit(10 ** scale)).cast("long")
    return F.sum(ints), F.count(values)
