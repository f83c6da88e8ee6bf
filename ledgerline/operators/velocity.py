"""Rolling per-account signals over event time, skew-safe.

A plain ``Window.partitionBy("account_id")`` sends all rows of an account
to one task; one hot account can then hold a large share of the table in a
single partition.  Instead:

1. pre-aggregate rows per (account, epoch second) — map-side partial
   aggregation, so the shuffle carries at most one row per second per
   account and map task;
2. cut time into cells at least as wide as the window; each per-second
   row is emitted for its own cell and, if it lies within one window of the
   next cell's start, as context for that cell too; the window runs per
   (account, cell), so a partition never holds more than cell + window
   distinct seconds of one account;
3. join the per-second results back to the rows on (account, second).

The result equals ``RANGE BETWEEN window PRECEDING AND CURRENT ROW`` over
``(account_id ORDER BY epoch second)`` exactly, same-second peers included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.timefn import epoch_seconds
from ledgerline.params import RiskParams

SEC = "_sec"
CELL = "_cell"
# The cell of rows without a time.
NO_TIME = -(1 << 62)
# Sliding frames cost up to the window's seconds a row; beyond this window the
# event form is used, which gives the same sums.
LONG_WINDOW_S = 3600


def cents(amount: Column) -> Column:
    """Amount in integer cents as decimal(38,0) (exact products and sums)."""
    return (amount * 100).cast("decimal(38,0)")


# Squares of cents are summed in two limbs: hi * LIMB + lo.
LIMB = 10 ** 18


def square_limbs(cents_: Column) -> tuple[Column, Column]:
    """(hi, lo) of the square of a long of at most 18 digits, as decimals for exact sums."""
    a = F.call_function("div", F.abs(cents_), F.lit(10 ** 9))
    b = F.abs(cents_) % F.lit(10 ** 9)
    mid = 2 * a * b
    hi = a * a + F.call_function("div", mid, F.lit(10 ** 9))
    lo = (mid % F.lit(10 ** 9)) * F.lit(10 ** 9) + b * b
    return hi.cast("decimal(20,0)"), lo.cast("decimal(20,0)")


def per_second(df: DataFrame, ts_col: str = "transaction_ts", key: str = "account_id") -> DataFrame:
    """(key, second) -> counts and exact sums used by every rolling signal."""
    hi, lo = square_limbs(cents(F.col("amount")).cast("long"))
    return (df.withColumn(SEC, epoch_seconds(ts_col))
            .groupBy(key, SEC)
            .agg(F.count("transaction_id").alias("n_id"),
                 F.count("amount").alias("n_amt"),
                 F.sum("amount").alias("s_amt"),
                 F.sum(hi.cast("decimal(28,0)")).alias("s_hi"),
                 F.sum(lo.cast("decimal(28,0)")).alias("s_lo")))


def cell_of(sec: Column, cell_s: int) -> Column:
    """The time cell of a second; rows without a time share one."""
    return F.coalesce(F.floor(sec / F.lit(int(cell_s))).cast("long"), F.lit(NO_TIME))


def default_cell(window_s: int) -> int:
    """Cell width for a window: wide enough that few rows are copied as
    context (only those within one window of the next cell), narrow enough
    that a partition holds at most cell + window seconds of one account."""
    return max(int(window_s), min(12 * int(window_s), 7 * 86400))


def trailing(per_sec: DataFrame, window_s: int, value_cols: Sequence[str],
             exclude_current: bool = False, key: str = "account_id",
             cell_s: int | None = None) -> DataFrame:
    """Sums of ``value_cols`` over seconds in [sec - window_s, sec - e].

    ``e`` is 0, or 1 with ``exclude_current``.  Time is cut into cells of
    ``cell_s`` (>= window) seconds; each per-second row belongs to its cell
    and, when it lies within one window of the next cell's start, is also
    copied there as context.  Output: key, sec and one ``<col>_w`` column
    per input column.
    """
    width = int(window_s)
    cell_w = int(cell_s or default_cell(width))
    if cell_w < width:
        raise ValueError("cell width must be at least the window length")
    sec = F.col(SEC)
    cell = F.floor(sec / F.lit(cell_w)).cast("long")
    own = F.struct(cell.alias("cell"), F.lit(True).alias("own"))
    ctx = F.struct((cell + 1).alias("cell"), F.lit(False).alias("own"))
    needed_next = sec >= (cell + 1) * F.lit(cell_w) - F.lit(width)
    spread = per_sec.withColumn("_c", F.explode(
        F.when(sec.isNotNull() & needed_next, F.array(own, ctx)).otherwise(F.array(own))))
    hi = -1 if exclude_current else 0
    w = (Window.partitionBy(key, F.col("_c.cell")).orderBy(sec)
         .rangeBetween(-width, hi))
    sums = [F.sum(c).over(w).alias(f"{c}_w") for c in value_cols]
    return (spread.select(key, SEC, F.col("_c.own").alias("_own"), *sums)
            .filter("_own").drop("_own"))


def trailing_rows(df: DataFrame, window_s: int, ts_col: str = "transaction_ts", key: str = "account_id",
                  cell_s: int | None = None) -> DataFrame:
    """The rows with ``n_id_w`` / ``s_amt_w`` of [sec - window_s, sec], in one shuffle.

    The rows themselves are dealt by (key, cell), with a copy of key, id, amount and
    second in the next cell where they lie within one window of its start, so nothing
    is joined back.  Where seconds rarely repeat, as on cards, this moves a third of
    what per-second sums and their join move; a partition holds the rows of one account
    in one cell.  Sums and counts equal those of ``trailing`` on ``per_second``.  The cell
    stays in the output (``CELL``, never NULL): a join on (key, cell) needs no further shuffle.
    """
    width = int(window_s)
    cell_w = int(cell_s or default_cell(width))
    if cell_w < width:
        raise ValueError("cell width must be at least the window length")
    sec = F.col(SEC)
    cell = cell_of(sec, cell_w)
    own = F.struct(cell.alias(CELL), F.lit(True).alias("_own"))
    context = F.struct((cell + 1).alias(CELL), F.lit(False).alias("_own"))
    needed_next = sec.isNotNull() & (sec >= (cell + 1) * F.lit(cell_w) - F.lit(width))
    rows = df.withColumn(SEC, epoch_seconds(ts_col))
    rows = rows.select("*", F.inline(F.when(needed_next, F.array(own, context)).otherwise(F.array(own))))
    light = {c: F.when(F.col("_own"), F.col(c)) for c in df.columns if c not in (key, "transaction_id", "amount")}
    w = Window.partitionBy(key, CELL).orderBy(sec).rangeBetween(-width, 0)
    sums = {"n_id_w": F.count("transaction_id").over(w), "s_amt_w": F.sum("amount").over(w)}
    return rows.withColumns(light).withColumns(sums).filter("_own").drop("_own", SEC)


def trailing_by_events(per_sec: DataFrame, window_s: int, value_cols: Sequence[str],
                       exclude_current: bool = False, key: str = "account_id",
                       cell_s: int = 86400) -> DataFrame:
    """``trailing`` for long windows, linear in the seconds of an account.

    A second's values enter at ``sec`` (one later with ``exclude_current``) and
    leave at ``sec + window_s + 1``; the sum at a second is the running sum of
    these events, read off where the second itself enters.  It runs inside
    cells of ``cell_s`` seconds, whatever the window, and starts from the
    totals of the account's earlier cells.  Counts and decimals are exact, so
    the result equals the sliding frame.  A nullable column is NULL where the
    frame holds no value of it; one that is never NULL comes out as 0 there.
    """
    sec, lag = F.col(SEC), int(exclude_current)
    nullable = [c for c in value_cols if per_sec.schema[c].nullable]
    sums = [*value_cols, *[f"_n_{c}" for c in nullable]]
    values = {c: F.coalesce(F.col(c), F.lit(0)) for c in nullable} | {f"_n_{c}": F.col(c).isNotNull().cast("int") for c in nullable}
    moves = F.array(F.struct((sec + lag).alias("t"), F.lit(True).alias("enters")),
                    F.struct((sec + int(window_s) + 1).alias("t"), F.lit(False).alias("enters")))
    events = per_sec.where(sec.isNotNull()).withColumns(values).select(key, *sums, F.inline(moves))
    events = events.select(key, "t", "enters", F.floor(F.col("t") / F.lit(cell_s)).cast("long").alias("_cell"),
                           *[F.when(F.col("enters"), F.col(c)).otherwise(-F.col(c)).alias(c) for c in sums])
    inside = Window.partitionBy(key, "_cell").orderBy("t").rangeBetween(Window.unboundedPreceding, -lag)
    running = (events.select(key, "t", "enters", "_cell", *[F.sum(c).over(inside).alias(c) for c in sums])
               .where("enters").withColumn(SEC, F.col("t") - lag))
    totals = events.groupBy(key, "_cell").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = Window.partitionBy(key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(F.col(key).alias("_k"), F.col("_cell").alias("_c"), *[F.sum(c).over(earlier).alias(f"{c}_before") for c in sums])
    both = running.join(carried, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_cell") == F.col("_c")))
    total = lambda c: F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"{c}_before"), F.lit(0))
    out = {c: F.when(total(f"_n_{c}") > 0, total(c)) if c in nullable else total(c) for c in value_cols}
    timed = both.select(key, SEC, *[x.alias(f"{c}_w") for c, x in out.items()])
    # without a time a row is its own frame
    untimed = per_sec.where(sec.isNull()).select(key, SEC, *[F.col(c).cast(timed.schema[f"{c}_w"].dataType).alias(f"{c}_w") for c in value_cols])
    return timed.unionByName(untimed)


def attach(rows: DataFrame, per_sec_out: DataFrame, ts_col: str = "transaction_ts",
           key: str = "account_id") -> DataFrame:
    """Join per-second results back to rows (null-safe on both keys)."""
    r = rows.withColumn(SEC, epoch_seconds(ts_col))
    p = per_sec_out.withColumnRenamed(key, "_k").withColumnRenamed(SEC, "_s")
    cond = r[key].eqNullSafe(p["_k"]) & r[SEC].eqNullSafe(p["_s"])
    return r.join(p, cond, "left").drop("_k", "_s", SEC)


def velocity_columns(df: DataFrame, params: RiskParams) -> DataFrame:
    """From ``n_id_w`` / ``s_amt_w`` to the published velocity columns."""
    return (df
            .withColumn("txn_count_5min", F.coalesce(F.col("n_id_w"), F.lit(0)).cast("long"))
            .withColumn("txn_sum_5min", F.col("s_amt_w").cast("decimal(20,2)"))
            .withColumn("velocity_flag", F.coalesce(
                (F.col("txn_count_5min") >= params.velocity_count)
                | (F.col("txn_sum_5min") >= params.velocity_amount), F.lit(False)))
            .drop("n_id_w", "s_amt_w"))


def velocity_signals(df: DataFrame, params: RiskParams = RiskParams(),
                     cell_s: int | None = None) -> DataFrame:
    """Rolling count and sum per account plus the velocity flag."""
    ps = per_second(df)
    if params.velocity_window_s > LONG_WINDOW_S and cell_s is None:
        tr = trailing_by_events(ps, params.velocity_window_s, ["n_id", "s_amt"])
    else:
        tr = trailing(ps, params.velocity_window_s, ["n_id", "s_amt"], cell_s=cell_s)
    return velocity_columns(attach(df, tr), params)
