"""Gold scoring: account statistics, amount outliers, weighted risk score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.numeric import round_ratio
from ledgerline.functions.timefn import epoch_seconds
from ledgerline.operators.velocity import LIMB, attach, cell_of, cents, per_second, square_limbs, trailing_by_events
from ledgerline.params import RiskParams


def _moments(n: Column, s_amt: Column, s_sq: Column) -> tuple[Column, Column, Column, Column]:
    """(sum of cents, whole mean m, remainder d, sum of squared deviations as double).

    The squares come in two limbs and are shifted by m before they become a
    double, so neither large amounts nor many rows overflow or cancel:
    sum (x - m)^2 = sum x^2 - n m^2 - 2 m d with sum x = n m + d.
    """
    big = "decimal(38,0)"
    rows = F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)).cast("decimal(20,0)")
    s_c = cents(s_amt)
    d = F.pmod(s_c, rows).cast(big)
    m = ((s_c - d) / rows).cast("decimal(20,0)")
    m_hi, m_lo = square_limbs(m.cast("long"))
    low = s_sq["lo"] - (rows * m_lo).cast(big) - (2 * m * d.cast("decimal(17,0)")).cast(big)
    low_part = F.pmod(low, F.lit(LIMB).cast("decimal(19,0)"))
    high = s_sq["hi"] - (rows * m_hi).cast(big) + ((low - low_part) / F.lit(LIMB).cast("decimal(19,0)")).cast(big)
    shifted = high.cast("double") * F.lit(float(LIMB)) + low_part.cast("double")
    return s_c, m, d, F.greatest(shifted - d.cast("double") * d.cast("double") / rows.cast("double"), F.lit(0.0))


def _stats_from_sums(n: Column, s_amt: Column, s_sq: Column) -> tuple[Column, Column]:
    """(sum of cents, sample variance as double)."""
    s_c, _, _, ss = _moments(n, s_amt, s_sq)
    return s_c, F.when(n > 1, ss / (n - 1).cast("double") / F.lit(10000.0))


def outlier_test(amount: Column, n: Column, s_amt: Column, s_sq: Column, z: float) -> Column:
    """std > 0 and |x - avg| / std > z, in doubles made from exact shifted sums.

    False when the standard deviation is 0 or undefined (fewer than two rows).
    """
    _, m, d, ss = _moments(n, s_amt, s_sq)
    rows = n.cast("double")
    off = (cents(amount) - m).cast("double") - d.cast("double") / rows
    test = off * off * (rows - 1.0) > F.lit(float(z) ** 2) * ss
    return F.when((n > 1) & (ss > 0) & amount.isNotNull(), test).otherwise(F.lit(False))


def _moment_sums(df: DataFrame, *by: Column | str) -> DataFrame:
    hi, lo = square_limbs(cents(F.col("amount")).cast("long"))
    return df.groupBy(*by).agg(
        F.count("amount").alias("n_amt"), F.sum("amount").alias("s_amt"), F.sum(hi).alias("_hi"), F.sum(lo).alias("_lo"))


def _squares() -> Column:
    return F.struct(F.col("_hi").alias("hi"), F.col("_lo").alias("lo")).alias("s_sq")


def account_stats(df: DataFrame) -> DataFrame:
    """G1: per-account count, average and sample standard deviation.

    Partial (map-side) aggregation of exact sums: a hot account is combined
    on every map task before the shuffle.
    """
    return _moment_sums(df, "account_id").select("account_id", "n_amt", "s_amt", _squares())


CELL_S = 3600


def spread_stats(df: DataFrame, cell_s: int = CELL_S) -> DataFrame:
    """The account statistics once for every hour in which the account has rows:
    (_a, _c, n_amt, s_amt, s_sq), for joins on (account, hour).

    Such a join deals a hot account's rows to as many tasks as it has hours.
    The sums are combined by account on the map side, where the hours are only
    listed: sums by hour would be about as many rows as the table.
    """
    known = df.filter(F.col("account_id").isNotNull())
    hours = known.select(F.col("account_id").alias("_a"), stats_cell(df, cell_s).alias("_c")).distinct()
    whole = _moment_sums(known, F.col("account_id").alias("_b"))
    return hours.join(whole, F.col("_a") == F.col("_b")).select("_a", "_c", "n_amt", "s_amt", _squares())


def stats_cell(df: DataFrame, cell_s: int = CELL_S) -> Column:
    """The hour of a row; rows without event times share one."""
    if "transaction_ts" not in df.columns:
        return F.lit(0).cast("long")
    return cell_of(epoch_seconds("transaction_ts"), cell_s)


def stats_columns(df: DataFrame) -> DataFrame:
    """Readable avg/std (4 dp) from the exact sums."""
    n = F.col("n_amt")
    s_c, var = _stats_from_sums(n, F.col("s_amt"), F.col("s_sq"))
    return df.select(
        "*",
        round_ratio(s_c, n * 100, 4).alias("avg_amount"),
        F.round(F.sqrt(var), 4).alias("std_amount"),
    )


def amount_outliers(df: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """P11 with J3 as a join of the aggregated statistics (no window per account).

    The rows are joined on (account, hour), see ``spread_stats``; rows without
    an account match nothing and are spread by their hours likewise.
    """
    st = spread_stats(df)
    rows = df.withColumn("_cell", stats_cell(df))
    out = rows.join(st, (F.col("account_id") == F.col("_a")) & (F.col("_cell") == F.col("_c")), "left").drop("_a", "_c", "_cell")
    out = out.withColumn("amount_outlier_flag", outlier_test(
        F.col("amount"), F.coalesce(F.col("n_amt"), F.lit(0)), F.col("s_amt"), F.col("s_sq"), params.zscore))
    return stats_columns(out).drop("n_amt", "s_amt", "s_sq")


def risk_score(df: DataFrame, params: RiskParams = RiskParams()) -> DataFrame:
    """Weighted score in double, rounded to 4 places, then the alert."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("double")
    score = F.round(
        flag("velocity_flag") * params.w_velocity
        + flag("high_risk_mcc_flag") * params.w_high_risk_mcc
        + F.coalesce(F.col("geo_risk_score").cast("double"), F.lit(0.0)) * params.w_geo
        + flag("amount_outlier_flag") * params.w_outlier, 4)
    return (df.withColumn("fraud_risk_score", score)
            .withColumn("fraud_alert", F.col("fraud_risk_score") >= params.alert_threshold))


GOLD_COLUMNS = [
    "transaction_id", "account_id", "card_number_token", "amount", "currency",
    "country_code", "mcc_code", "channel", "transaction_ts", "ingest_date",
    "txn_date", "region", "fraud_risk_score", "fraud_alert", "velocity_flag",
    "high_risk_mcc_flag", "amount_outlier_flag",
]


def gold_transactions(df: DataFrame) -> DataFrame:
    """The Gold projection; ``txn_date`` is the event date."""
    return df.withColumn("txn_date", F.to_date("transaction_ts")).select(*GOLD_COLUMNS)


def trailing_outliers(df: DataFrame, days: int = 30, params: RiskParams = RiskParams()) -> DataFrame:
    """Z-score against the account's trailing ``days`` (current second excluded).

    Uses the running sums of ``velocity`` (exact counts, sums and sums of
    squares) inside one-day cells, so a hot account is split by time and the
    work is linear in its seconds.
    """
    # sums of nothing may be 0: every use below asks for the count first
    ps = per_second(df).withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("s_amt", "s_hi", "s_lo")})
    tr = trailing_by_events(ps, days * 86400, ["n_amt", "s_amt", "s_hi", "s_lo"], exclude_current=True)
    out = attach(df, tr)
    n = F.coalesce(F.col("n_amt_w"), F.lit(0)).cast("long")
    s_sq = F.struct(F.col("s_hi_w").alias("hi"), F.col("s_lo_w").alias("lo"))
    s_c, var = _stats_from_sums(n, F.col("s_amt_w"), s_sq)
    return out.select(
        "*",
        n.alias("prior_txn_count"),
        round_ratio(s_c, n * 100, 4).alias("trailing_avg"),
        F.round(F.sqrt(var), 4).alias("trailing_std"),
        outlier_test(F.col("amount"), n, F.col("s_amt_w"), s_sq, params.zscore)
        .alias("trailing_outlier_flag"),
    ).drop("n_amt_w", "s_amt_w", "s_hi_w", "s_lo_w")
