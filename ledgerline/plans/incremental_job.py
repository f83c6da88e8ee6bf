"""The incremental run as a job that stores its mark and survives a crash at any step.

A run goes through four steps, each ended by a record in the ledger, a table of a
few rows a run beside the target:

    planned    the mark it starts from (I1) and its number
    staged     the extracted rows (I2) are in the shared folder; their largest
               ``updated_at`` is the mark to come
    prepared   the new content of the touched partitions is in the shared folder
    committed  the target shows it (I4) and the mark is the new one (I3)

The stored mark is that of the last committed run, and it never moves back.  A run
without a commit is resumed where its records end: what was staged is not read from
the source again, what was prepared is put in place from the staged copy however far
the change of the target had come.  Rows without a key go to ``<target>_quarantine``, a
folder for each run, before the upsert.  One run at a time for a target.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators import incremental as inc
from ledgerline.params import IncrementalParams
from ledgerline.runtime import path_exists, scratch_path
from ledgerline.sinks.writers import drop_stage

PLANNED, STAGED, PREPARED, COMMITTED = "planned", "staged", "prepared", "committed"

LEDGER = T.StructType([
    T.StructField("source_system", T.StringType(), False),
    T.StructField("run_no", T.LongType(), False),
    T.StructField("step", T.StringType(), False),
    T.StructField("mark", T.TimestampNTZType()),        # planned: the old one; staged on: the new one
    T.StructField("rows", T.LongType()),                # staged: extracted; prepared, committed: published
    T.StructField("detail", T.StringType()),            # paths, as JSON
    T.StructField("recorded_at", T.TimestampNTZType()),
])


@dataclass(frozen=True)
class Job:
    """What stays the same from run to run."""
    target_path: str
    partition_col: str
    keys: tuple[str, ...] = ("transaction_id",)
    order_col: str = "updated_at"
    params: IncrementalParams = IncrementalParams()

    @property
    def ledger_path(self) -> str:
        return self.target_path.rstrip("/") + "_ledger"


def read_ledger(spark: SparkSession, job: Job) -> DataFrame:
    if not path_exists(spark, job.ledger_path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(job.ledger_path)


def marks(ledger: DataFrame) -> DataFrame:
    """The control table (source_system, last_processed_ts, updated_at): the last commit of each source."""
    last = ledger.where(F.col("step") == COMMITTED).groupBy("source_system").agg(
        F.max("mark").alias("last_processed_ts"), F.max("recorded_at").alias("updated_at"))
    return last.select(*schemas.WATERMARKS.names)


def _record(spark: SparkSession, job: Job, run_no: int, step: str, mark: dt.datetime | None, rows: int | None, detail: dict, now: dt.datetime) -> None:
    row = (job.params.source_system, run_no, step, mark, rows, json.dumps(detail, sort_keys=True), now)
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(job.ledger_path)


def _last_run(ledger: DataFrame, source: str) -> dict[str, object]:
    """step -> record of the latest run of ``source``; four records at most."""
    mine = ledger.where(F.col("source_system") == source)
    newest = mine.agg(F.max("run_no").alias("n")).first()["n"]
    return {} if newest is None else {r["step"]: r for r in mine.where(F.col("run_no") == newest).collect()}


def run(spark: SparkSession, job: Job, source: Callable[[], DataFrame], now: dt.datetime) -> dict[str, object]:
    """Run or resume one increment.  ``source`` returns the source table; it is called only if rows must be extracted.

    Returns the run's number, mark, extracted and published rows.
    """
    name = job.params.source_system
    ledger = read_ledger(spark, job)
    seen = _last_run(ledger, name)
    if not seen or COMMITTED in seen:  # nothing to resume
        number = seen[COMMITTED]["run_no"] + 1 if seen else 1
        mark = inc.watermark_value(marks(ledger), name)
        # no run is under way here, so that a target without a path has never had rows
        _record(spark, job, number, PLANNED, mark, None, {"first": not path_exists(spark, job.target_path)}, now)
        seen = _last_run(read_ledger(spark, job), name)
    number, start = seen[PLANNED]["run_no"], seen[PLANNED]["mark"]
    if STAGED not in seen:
        _record(spark, job, number, STAGED, *stage(spark, job, source(), start, number), now)
        seen = _last_run(read_ledger(spark, job), name)
    if PREPARED not in seen:
        _record(spark, job, number, PREPARED, seen[STAGED]["mark"], *prepare(spark, job, seen), now)
        seen = _last_run(read_ledger(spark, job), name)
    publish(spark, job, seen)
    _record(spark, job, number, COMMITTED, seen[STAGED]["mark"], seen[PREPARED]["rows"], {}, now)
    for step in (STAGED, PREPARED):
        drop_stage(spark, json.loads(seen[step]["detail"])["path"])
    return {"run_no": number, "mark": seen[STAGED]["mark"], "extracted": seen[STAGED]["rows"], "published": seen[PREPARED]["rows"]}


def stage(spark: SparkSession, job: Job, source: DataFrame, start: dt.datetime, number: int) -> tuple[dt.datetime, int, dict]:
    """I2 and the value of I3: (new mark, rows, where the extract is stored)."""
    path, obs = scratch_path(spark, f"extract-{number}"), Observation("extract")
    rows = inc.extract_incremental(source, start, job.params)
    keyed = inc.keyed(rows, job.keys)
    seen = rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.max("updated_at").alias("mark"), F.count_if(~keyed).alias("nulls"))
    seen.withColumn("_keyed", keyed).write.partitionBy("_keyed").parquet(path)
    got = obs.get
    return max(got["mark"] or start, start), got["rows"], {"path": path, "nulls": got["nulls"], "schema": source.schema.json()}


def _extract(spark: SparkSession, staged) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without) of a staged extract."""
    detail = json.loads(staged["detail"])
    schema = T.StructType.fromJson(json.loads(detail["schema"]))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("_keyed", T.BooleanType())])).parquet(detail["path"])
    return rows.where("_keyed").drop("_keyed"), rows.where("not _keyed").drop("_keyed")


def prepare(spark: SparkSession, job: Job, seen: dict) -> tuple[int, dict]:
    """(rows to publish, where the new partitions are stored)."""
    good, nameless = _extract(spark, seen[STAGED])
    if json.loads(seen[STAGED]["detail"])["nulls"]:
        nameless.write.mode("overwrite").parquet(f"{job.target_path.rstrip('/')}_quarantine/run_no={seen[STAGED]['run_no']}")
    first = json.loads(seen[PLANNED]["detail"])["first"]
    p = inc.prepare_upsert(spark, job.target_path, good, job.partition_col, job.keys, job.order_col, exists=not first)
    return p.rows, {"path": p.path, "stale": p.stale, "schema": good.schema.json()}


def publish(spark: SparkSession, job: Job, seen: dict) -> None:
    detail = json.loads(seen[PREPARED]["detail"])
    prepared = inc.Prepared(detail["path"], seen[PREPARED]["rows"], detail["stale"])
    inc.publish_upsert(spark, job.target_path, prepared, T.StructType.fromJson(json.loads(detail["schema"])), job.partition_col)


def current_rows(spark: SparkSession, job: Job, schema: T.StructType) -> DataFrame:
    """The target, in the types of ``schema``."""
    return spark.read.schema(schema).parquet(job.target_path)
