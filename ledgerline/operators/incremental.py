"""High-water-mark extraction, key upsert and as-of reads.

There is no transactional table format here: an upsert is computed as a
DataFrame (anti join + union) and published by rewriting only the touched
partitions through a staging copy (``sinks.writers.publish_partitions``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.functions.timefn import epoch_seconds, ts_literal
from ledgerline.operators.quality import dedup_latest
from ledgerline.params import IncrementalParams
from ledgerline.runtime import scratch_path
from ledgerline.sinks import key_index
from ledgerline.sinks.writers import drop_stage, stage_rows, write_partitioned

EPOCH = dt.datetime(1970, 1, 1)


def watermark_value(wm: DataFrame | None, source: str) -> dt.datetime:
    """Latest mark of ``source``; 1970-01-01 when absent.

    The control table holds a handful of rows; the one scalar comes back to
    the driver so the extract filter is a literal that Parquet can push into
    row-group statistics.
    """
    if wm is None:
        return EPOCH
    row = (wm.filter(F.col("source_system") == source)
           .agg(F.max("last_processed_ts").alias("m")).first())
    return row["m"] if row is not None and row["m"] is not None else EPOCH


def extract_incremental(src: DataFrame, mark: dt.datetime,
                        params: IncrementalParams = IncrementalParams()) -> DataFrame:
    """Rows with ``updated_at`` strictly after mark minus the grace period."""
    start = mark - dt.timedelta(minutes=params.grace_minutes)
    return src.filter(F.col("updated_at") > ts_literal(start))


def advance_watermark(spark: SparkSession, wm: DataFrame | None, source: str,
                      extracted: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """New control table; the mark is the max over the extracted rows
    and never moves back.  Other sources' rows are kept."""
    old = watermark_value(wm, source)
    new = extracted.agg(F.max("updated_at").alias("m"))
    row = new.select(
        F.lit(source).alias("source_system"),
        F.greatest(F.coalesce(F.col("m"), ts_literal(old)),
                   ts_literal(old)).alias("last_processed_ts"),
        ts_literal(run_ts).alias("updated_at"))
    if wm is None:
        return row
    return wm.filter(F.col("source_system") != source).select(*schemas.WATERMARKS.names).unionByName(row)


class NullKeyError(ValueError):
    """Updates hold rows without a key, which no upsert could ever find again."""


def keyed(df: DataFrame, keys: Sequence[str]) -> Column:
    """Condition: every key column is set."""
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def merge_frames(target: DataFrame, updates: DataFrame, keys: Sequence[str] = ("transaction_id",),
                 order_col: str = "updated_at") -> DataFrame:
    """I4/J7 as a pure plan: latest update per key replaces the target row,
    new keys are inserted (update-all / insert-all).  Updates without a key are
    left out: they would match nothing and pile up with each run."""
    upd = dedup_latest(updates.filter(keyed(updates, keys)), keys, (order_col,))
    kept = target.join(upd.select(*keys), list(keys), "left_anti")
    return kept.unionByName(upd.select(*target.columns))


@dataclass(frozen=True)
class Prepared:
    """A staged upsert: what ``publish_upsert`` puts in place, as often as it is asked to."""
    path: str           # the new content of every touched partition
    rows: int
    stale: list[str]    # partition directories that end up without rows


def prepare_upsert(spark: SparkSession, target_path: str, updates: DataFrame,
                   partition_col: str, keys: Sequence[str] = ("transaction_id",),
                   order_col: str = "updated_at", exists: bool = True, unique: bool = False) -> Prepared:
    """First half of ``upsert``: everything but the change of the target.

    Touched are the partitions of the updates and those that hold one of the
    updated keys (a key may move); the key index beside the table
    (``sinks.key_index``) names them, so the rest of the table is neither read
    nor joined.  ``unique`` says that the updates have one row a key already, so
    that they need no shuffle by key to make them so.
    """
    rows, nulls = F.count(F.lit(1)).alias("rows"), F.count_if(~keyed(updates, keys)).alias("nulls")
    index = key_index.index_path(target_path)
    # the deduplicated updates are used by several jobs below: stored once in the shared folder
    stage, obs = scratch_path(spark, "upsert"), Observation("updates")
    seen = updates.observe(obs, rows, nulls)
    (seen if unique else dedup_latest(seen, keys, (order_col,))).write.parquet(stage)
    if obs.get["nulls"]:
        drop_stage(spark, stage)
        raise NullKeyError(f"{obs.get['nulls']} of {obs.get['rows']} updates have no {' / '.join(keys)}")
    upd = spark.read.schema(updates.schema).parquet(stage)
    if not exists:
        key_index.build(upd, index, keys, partition_col)
        return Prepared(stage, upd.count(), [])
    target = _typed_target(spark, target_path, upd, partition_col)
    key_index.ensure(spark, target, index, keys, partition_col)
    upd = upd.select(*target.columns)
    touched = key_index.locate_and_extend(spark, index, upd, keys, partition_col)
    if not touched:
        return Prepared(stage, 0, [])
    # partition values are metadata: the scope is a literal filter, pruned to those directories
    part = F.col(partition_col)
    in_scope = part.isin([v for v in touched if v is not None])
    scope = target.filter(in_scope | part.isNull() if None in touched else in_scope)
    before = partition_dirs(scope, partition_col)
    new_scope = scope.join(upd.select(*keys), list(keys), "left_anti").unionByName(upd)
    n, staged, copy = stage_rows(spark, new_scope, [partition_col])
    drop_stage(spark, stage)
    return Prepared(copy, n, sorted(before - partition_dirs(staged, partition_col)))


def publish_upsert(spark: SparkSession, target_path: str, prepared: Prepared, schema: T.StructType, partition_col: str) -> int:
    """Second half: replace the touched partitions from the staged copy.

    Reads nothing of the target, so after a crash in the middle it is simply
    called again, and the partitions come out whole.  A partition whose keys
    all moved away is never written by a dynamic overwrite; it is removed.
    """
    if prepared.rows:
        staged = spark.read.schema(schema).parquet(prepared.path)
        write_partitioned(staged, target_path, [partition_col], mode="overwrite")
    for name in prepared.stale:
        _delete_partition(spark, target_path, name)
    return prepared.rows


def upsert(spark: SparkSession, target_path: str, updates: DataFrame,
           partition_col: str, keys: Sequence[str] = ("transaction_id",),
           order_col: str = "updated_at", exists: bool = True, unique: bool = False) -> int:
    """I4 with storage: rewrite only partitions the updates touch.

    Updates without a key are refused before anything is changed.  Returns the
    rows published.  Re-running with the same updates gives the same table; a
    job that must survive a crash while publishing keeps the ``Prepared`` in a
    ledger (``plans.incremental_job``).
    """
    prepared = prepare_upsert(spark, target_path, updates, partition_col, keys, order_col, exists, unique)
    n = publish_upsert(spark, target_path, prepared, updates.schema, partition_col)
    drop_stage(spark, prepared.path)
    return n


def _typed_target(spark: SparkSession, path: str, updates: DataFrame, partition_col: str) -> DataFrame:
    """The target with the partition column in the updates' type: directory
    names alone would turn "01" into 1."""
    kind = updates.schema[partition_col].dataType
    # the data columns come from one file's footer, not from the rows
    fields = [T.StructField(f.name, kind if f.name == partition_col else f.dataType) for f in spark.read.parquet(path).schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def partition_dirs(df: DataFrame, col: str) -> set[str]:
    """Directory names (``col=value``, as stored) that hold the rows of a scan."""
    name = F.regexp_extract(F.col("_metadata.file_path"), f"/({col}=[^/]*)/", 1)
    return {unquote(r[0]) for r in df.select(name).distinct().collect()}


def _delete_partition(spark: SparkSession, path: str, name: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"), name)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def as_of(versions: DataFrame, ts: dt.datetime, keys: Sequence[str] = ("transaction_id",),
          valid_from: str = "valid_from") -> DataFrame:
    """A10: the version of each key valid at ``ts`` (latest ``valid_from <= ts``).

    Filter first (pushed to the scan), then a top-1 per key, which the
    planner pre-limits on the map side before the shuffle.
    """
    cand = versions.filter(F.col(valid_from) <= ts_literal(ts))
    w = Window.partitionBy(*keys).orderBy(F.col(valid_from).desc(),
                                          F.xxhash64(*[F.col(c) for c in versions.columns]).desc())
    return cand.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def build_history(versions: DataFrame, keys: Sequence[str] = ("transaction_id",),
                  valid_from: str = "valid_from", bucket_s: int = 3600) -> DataFrame:
    """A10: SCD2 history, ``valid_to`` = next version's ``valid_from`` per key.

    A per-key ``lead`` would hold every version of a key in one task.
    Instead ``lead`` runs within (key, time bucket) partitions; the last
    version of a bucket takes the first ``valid_from`` of the key's next
    non-empty bucket, found by a window over per-bucket summaries (one row
    per key and bucket, so bounded by the time span, not by row count).
    Versions with equal ``valid_from`` are ordered by a row hash; all but
    the last get an empty interval.
    """
    tie = F.xxhash64(*[F.col(c) for c in versions.columns])
    vf = F.col(valid_from)
    v = versions.withColumn("_b", F.floor(epoch_seconds(vf) / F.lit(int(bucket_s))).cast("long"))
    w_in = Window.partitionBy(*keys, "_b").orderBy(vf.asc_nulls_first(), tie)
    v = v.withColumn("_next_in", F.lead(vf).over(w_in))
    summ = v.groupBy(*keys, "_b").agg(F.min(vf).alias("_bmin"))
    w_b = Window.partitionBy(*keys).orderBy(F.col("_b").asc_nulls_first())
    summ = summ.withColumn("_next_b", F.lead("_bmin").over(w_b)).drop("_bmin")
    # plain equality on (keys, bucket): the join reuses the window's hash
    # partitioning, so the versions are shuffled once (a NULL key keeps its
    # in-bucket links only)
    out = v.join(summ, [*keys, "_b"], "left")
    valid_to = F.when(vf.isNull(), F.lit(None)).otherwise(F.coalesce(F.col("_next_in"), F.col("_next_b")))
    return out.select(*versions.columns, valid_to.cast(versions.schema[valid_from].dataType).alias("valid_to"))


def current_at(history: DataFrame, ts: dt.datetime, valid_from: str = "valid_from") -> DataFrame:
    """Rows of an SCD2 history valid at ``ts``."""
    t = ts_literal(ts)
    return history.filter((F.col(valid_from) <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))
