"""Reversible PAN vault (AES-GCM), kept apart from the tokenised data.

Keys come from a table (key_id, key, salt) that only the vault's jobs may read, and
reach the rows by a join on ``key_id``: neither a key nor the salt is ever a literal
of a plan.  Each entry names the key that encrypted it, so that after a new key
old entries still decrypt, and a rotation re-encrypts those alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.pan import pan_token
from ledgerline.runtime import delete_path
from ledgerline.sinks.writers import write_partitioned

KEYS = "key_id int, key binary, salt string"
VAULT = "card_number_token string, ciphertext binary, key_id int"


def active_key(keys: DataFrame) -> int:
    """The newest key's number (not secret)."""
    newest = keys.agg(F.max("key_id").alias("n")).first()["n"]
    if newest is None:
        raise ValueError("the key table is empty")
    return newest


def vault(df: DataFrame, keys: DataFrame, col: str = "card_number") -> DataFrame:
    """(token, ciphertext, key_id) per distinct PAN, under the newest key.

    ``distinct`` aggregates partially on the map side, so a card used by a
    huge share of rows is combined before the shuffle.  AES-GCM draws a
    random IV, so ciphertexts differ run to run; ``unvault`` decrypts them.
    """
    pans = df.select(F.col(col).alias("pan")).filter(F.col("pan").isNotNull()).distinct()
    keyed = pans.withColumn("key_id", F.lit(active_key(keys))).join(F.broadcast(keys), "key_id")  # a row a key
    return keyed.select(pan_token(F.col("pan"), F.col("salt")).alias("card_number_token"),
                        F.aes_encrypt(F.col("pan"), F.col("key"), F.lit("GCM")).alias("ciphertext"), "key_id")


def _opened(v: DataFrame, keys: DataFrame) -> DataFrame:
    plain = F.aes_decrypt(F.col("ciphertext"), F.col("key"), F.lit("GCM")).cast("string")
    return v.join(F.broadcast(keys.select("key_id", "key")), "key_id").select("card_number_token", plain.alias("card_number"))


def unvault(v: DataFrame, keys: DataFrame) -> DataFrame:
    """(token, card number) of entries under any key of the table."""
    return _opened(v, keys)


def rotated(v: DataFrame, keys: DataFrame) -> DataFrame:
    """Entries under older keys, re-encrypted under the newest; tokens stay as they are."""
    newest = active_key(keys)
    old = _opened(v.where(F.col("key_id") < newest), keys).withColumn("key_id", F.lit(newest))
    return old.join(F.broadcast(keys.select("key_id", "key")), "key_id").select(
        "card_number_token", F.aes_encrypt(F.col("card_number"), F.col("key"), F.lit("GCM")).alias("ciphertext"), "key_id")


def store(entries: DataFrame, path: str) -> None:
    """Append vault entries, a folder a key."""
    write_partitioned(entries, path, ["key_id"])


def rotate_stored(spark: SparkSession, path: str, keys: DataFrame) -> int:
    """Re-encrypt the entries under older keys and drop their folders.  Returns the entries moved.

    Only older folders are decrypted.  After a crash it is called again: tokens
    that have arrived under the newest key are left out.
    """
    newest = active_key(keys)
    stored = spark.read.schema(VAULT).parquet(path)
    here = stored.where(F.col("key_id") == newest).select("card_number_token")
    waiting = stored.where(F.col("key_id") < newest)
    older = [r[0] for r in waiting.select("key_id").distinct().collect()]  # partition values
    if not older:
        return 0
    before = here.count()
    store(rotated(waiting, keys).dropDuplicates(["card_number_token"]).join(here, "card_number_token", "left_anti"), path)
    spark.catalog.refreshByPath(path)
    moved = spark.read.schema(VAULT).parquet(path).where(F.col("key_id") == newest).count() - before
    for key_id in older:
        delete_path(spark, f"{path.rstrip('/')}/key_id={key_id}")
    return moved
