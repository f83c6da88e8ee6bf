"""Plain definitions that the split operators are tested against."""

from pyspark.sql import functions as F

from ledgerline.functions.timefn import epoch_seconds
from ledgerline.operators.velocity import velocity_columns
from ledgerline.params import RiskParams


def velocity_by_self_join(df, params=RiskParams()):
    """Each row joined with the rows of its account from ``velocity_window_s`` before to its own second."""
    rows = df.withColumns({"_sec": epoch_seconds("transaction_ts"), "_row": F.monotonically_increasing_id()}).cache()
    other = rows.select(F.col("account_id").alias("_acct"), F.col("_sec").alias("_then"), F.col("transaction_id").alias("_id"), F.col("amount").alias("_amt"))
    ago = F.col("_sec") - F.col("_then")
    met = (rows.select("_row", "_sec", "account_id").join(other, F.col("account_id").eqNullSafe(F.col("_acct"))).where(ago.between(0, params.velocity_window_s) | (F.col("_sec").isNull() & F.col("_then").isNull()))
           .groupBy("_row").agg(F.count("_id").alias("n_id_w"), F.sum("_amt").alias("s_amt_w")))
    return velocity_columns(rows.join(met, "_row", "left").drop("_row", "_sec"), params)
