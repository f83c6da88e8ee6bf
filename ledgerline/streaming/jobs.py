"""Structured Streaming jobs built from the same column functions as batch.

* ``start_event_stream``: envelopes -> decode -> redact -> validate, routed
  by ``foreachBatch`` into valid and dead-letter rows (S1, B13, B14), one
  write job per micro-batch.  Each micro-batch writes its own
  ``batch_id=N`` directory with overwrite, so a batch replayed after a
  failure replaces itself instead of duplicating (exactly-once output with
  the checkpointed offsets).
* ``dedup_stream`` (S4), ``windowed_kpis`` (S7) and ``velocity_stream``
  (S5, exact trailing window through state per account bucket and time cell).
* late events (S8) go to the dead letter with a reason of their own.
* ``score_stream`` / ``start_scoring_stream``: real-time risk scoring
  (velocity state, enrichment, account statistics that are looked up again
  for every batch), exactly-once by batch directories.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ledgerline import schemas
from ledgerline.functions.pan import was_redacted
from ledgerline.operators.contract import STREAM_REQUIRED
from ledgerline.operators.kpis import _kpi_aggs, _with_rate
from ledgerline.params import RiskParams
from ledgerline.runtime import bounded_broadcast, checkpoint_root, path_exists
from ledgerline.streaming import statistics
from ledgerline.streaming.envelope import DECODE_FAILED, LATE_ARRIVAL, SCHEMA_VALIDATION_FAILED, decode_envelope, routed
from ledgerline.functions.timefn import epoch_seconds, ts_literal

log = logging.getLogger(__name__)

# Stored account statistics up to this size (four numbers an account) are broadcast.
STATS_BROADCAST_MAX_BYTES = 32 << 20


def event_time(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP on the UTC time line (for watermarks), zone-free."""
    col = F.col(ts) if isinstance(ts, str) else ts
    micros = (F.extract(F.lit("SECOND"), col) * 1_000_000).cast("long") % 1_000_000
    return F.timestamp_micros(epoch_seconds(col) * 1_000_000 + micros)


def read_event_stream(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Newline-JSON envelope files arriving in ``src_dir``."""
    r = spark.readStream.schema(schemas.ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(src_dir)


REASON_COUNTS = {"decode_failed": DECODE_FAILED, "schema_failed": SCHEMA_VALIDATION_FAILED, "late": LATE_ARRIVAL}
METRIC_COUNTS = ("events", "valid", *REASON_COUNTS, "redacted")
BATCH_METRICS = ", ".join(f"{c} long" for c in (*METRIC_COUNTS, "write_ms"))


def read_batch_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """What each micro-batch counted on its own write, and the milliseconds it took."""
    return spark.read.schema(BATCH_METRICS + ", batch_id long").parquet(metrics_path)


def route_batch(out_path: str, failed_at: dt.datetime | None = None, late_after_s: int | None = None,
                metrics_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body; one write job per micro-batch.

    Rows land in ``out_path/batch_id=N/route=valid|dead``; overwrite of the
    batch directory makes a replayed batch replace itself.

    With ``late_after_s`` (S8), a complete event more than that many seconds
    behind the latest event of the batches before goes to the dead letter as
    LATE_ARRIVAL instead of being dropped by a watermark downstream, so valid and
    dead rows together are the input.  The latest event time is observed on the
    write itself and kept per batch in ``<out_path>_marks``: a replayed batch
    is judged by the same mark as the first time.  With ``metrics_path`` (S2) the
    counts observed on the write are kept there, a row a batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stamp = ts_literal(failed_at) if failed_at else F.localtimestamp()
        mark = late = None
        if late_after_s is not None:
            mark = read_mark(spark, out_path, batch_id - 1)
            if mark is not None:
                late = F.col("transaction_ts") < ts_literal(mark - dt.timedelta(seconds=late_after_s))
        # rows that come routed already cost no planning of the routing in each batch
        out = batch if "route" in batch.columns else routed(batch, late)
        out = out.withColumn("failed_at", F.when(F.col("route") == "dead", stamp))
        seen, started = Observation("batch"), time.monotonic()
        reason = F.col("reason")
        counted = late_after_s is not None or metrics_path is not None
        if counted:
            out = out.observe(
                seen, F.count(F.lit(1)).alias("events"), F.count_if(reason.isNull()).alias("valid"),
                *[F.count_if(F.coalesce(reason == r, F.lit(False))).alias(name) for name, r in REASON_COUNTS.items()],
                F.count_if("redacted").alias("redacted"),
                F.max(F.when(reason.isNull() | (reason == LATE_ARRIVAL), F.col("transaction_ts"))).alias("mark"))
        out.write.mode("overwrite").partitionBy("route").parquet(f"{out_path}/batch_id={batch_id}")
        if not counted:
            return
        counts = dict(seen.get)
        latest = counts.pop("mark")
        if late_after_s is not None:
            known = [x for x in (mark, latest) if x is not None]
            row = spark.createDataFrame([(max(known) if known else None,)], "mark timestamp_ntz")
            row.coalesce(1).write.mode("overwrite").parquet(f"{marks_path(out_path)}/batch_id={batch_id}")
        if metrics_path is not None:
            took = round((time.monotonic() - started) * 1000)
            row = spark.createDataFrame([(*(counts[c] for c in METRIC_COUNTS), took)], BATCH_METRICS)
            row.coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/batch_id={batch_id}")
    return write


def marks_path(out_path: str) -> str:
    return out_path.rstrip("/") + "_marks"


def read_mark(spark: SparkSession, out_path: str, batch_id: int) -> dt.datetime | None:
    """Latest event time up to a batch; None before the first."""
    path = f"{marks_path(out_path)}/batch_id={batch_id}"
    if not path_exists(spark, path):
        return None
    return spark.read.schema("mark timestamp_ntz").parquet(path).first()["mark"]


def read_routed(spark: SparkSession, out_path: str) -> tuple[DataFrame, DataFrame]:
    """(valid table, dead-letter table) of a routed stream output."""
    from ledgerline.streaming.envelope import DEAD_COLUMNS, VALID_COLUMNS
    r = spark.read.parquet(out_path)
    return (r.filter(F.col("route") == "valid").select(*VALID_COLUMNS, "batch_id"),
            r.filter(F.col("route") == "dead").select(*DEAD_COLUMNS, "failed_at", "batch_id"))


def start_event_stream(spark: SparkSession, src_dir: str, out_path: str,
                       checkpoint: str | None = None, available_now: bool = True,
                       failed_at: dt.datetime | None = None,
                       max_files_per_trigger: int | None = None,
                       late_after_s: int | None = None, metrics_path: str | None = None) -> StreamingQuery:
    """One read, one routed write per micro-batch; counts observable
    in the query progress (``observedMetrics['routing']``)."""
    decoded = decode_envelope(read_event_stream(spark, src_dir, max_files_per_trigger))
    complete = ~F.col("decode_error")
    for name in STREAM_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    observed = decoded.observe(
        "routing",
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("decode_error")).alias("decode_failed"),
        F.count_if(complete).alias("valid"),
        F.count_if(~complete & ~F.col("decode_error")).alias("schema_failed"),
        F.count_if(was_redacted(F.col("card_number"))).alias("redacted"))
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/events"
    # without a mark the routing is the same for every batch: it is planned with the stream
    rows = routed(observed) if late_after_s is None else observed
    w = (rows.writeStream.foreachBatch(route_batch(out_path, failed_at, late_after_s, metrics_path))
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


class LatencyListener(StreamingQueryListener):
    """Records micro-batches whose total duration exceeds a budget."""

    def __init__(self, budget_ms: int = 500):
        self.budget_ms = budget_ms
        self.slow: list[tuple[int, int]] = []

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        total = (p.durationMs or {}).get("triggerExecution", 0)
        if total > self.budget_ms:
            self.slow.append((p.batchId, total))
            log.warning("micro-batch %s took %s ms (budget %s ms)", p.batchId, total, self.budget_ms)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def dedup_stream(events: DataFrame, delay: str = "1 hour", key: str = "transaction_id",
                 ts: str = "transaction_ts") -> DataFrame:
    """At-least-once delivery -> one row per key within the watermark."""
    return (events.withColumn("event_time", event_time(ts))
            .withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark([key]))


def windowed_kpis(events: DataFrame, window: str = "1 hour", delay: str = "30 minutes",
                  ts: str = "transaction_ts") -> DataFrame:
    """Tumbling-window KPI roll-up, appended once the watermark closes a window.

    Rows later than ``delay`` would be dropped by the watermark (and reported as
    ``numRowsDroppedByWatermark``); feed it valid rows of ``start_event_stream``
    with ``late_after_s`` of the same delay, and late events are in the dead
    letter instead.
    """
    e = events.withColumn("event_time", event_time(ts)).withWatermark("event_time", delay)
    g = e.groupBy(F.window("event_time", window).alias("w"), "region", "channel").agg(*_kpi_aggs())
    g = _with_rate(g)
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


VELOCITY_OUT = ("transaction_id string, account_id string, transaction_ts timestamp_ntz, "
                "amount decimal(18,2), txn_count_5min long, txn_sum_5min decimal(20,2), velocity_flag boolean")
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def velocity_processor(win: int, min_count: int, min_cents: int):
    """The state of one (bucket of accounts, time cell): a map from (account, second) to its sums and rows.

    A batch reads and writes the seconds its rows fall into and no others.  A
    timer fires when the watermark passes the first waiting second; its rows are
    then final and leave with the sums of the window before them.  Seconds that no
    later window reaches are removed, so the state holds the watermark delay
    and one window.  The class is made here and captures plain numbers only, so
    Python workers can run it without importing this package.
    """
    import json
    from decimal import Decimal

    import numpy as np
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    epoch, nobody = pd.Timestamp("1970-01-01"), "\0"  # stands for a missing account

    class Velocity(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.seconds = handle.getMapState("seconds", "account string, sec long", "n long, cents long, has long, rows string")
            self.done = handle.getValueState("done", "ms long")

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802
            new: dict[tuple, list] = {}
            for x in rows:
                cents = x["cents"].astype("object").where(x["cents"].notna(), None)
                for own, account, sec, us, c, name, kept in zip(x["own"], x["account_id"], x["sec"], x["us"], cents, x["transaction_id"], x["kept"]):
                    at = new.setdefault((nobody if account is None else account, int(sec)), [0, 0, 0, []])
                    at[0] += 1
                    if c is not None:
                        at[1], at[2] = at[1] + int(c), at[2] + 1
                    if own:
                        at[3].append([name, int(us), None if c is None else int(c), kept])
            known = self.seconds.exists()  # each call is a round trip to the state store
            for at, (n, c, has, own) in new.items():
                old = self.seconds.getValue(at) if known else None
                if old is not None:
                    n, c, has, own = n + old[0], c + old[1], has + old[2], json.loads(old[3]) + own
                self.seconds.updateValue(at, (n, c, has, json.dumps(own)))
            self.handle.registerTimer(min(sec + 1 if x[3] else sec + 1 + win for (_, sec), x in new.items()) * 1000)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
            now = timerValues.getCurrentWatermarkInMs()
            last = self.done.get()
            if last is not None and last[0] == now:  # another timer of the same batch
                return iter(())
            held = sorted((k, v) for k, v in self.seconds.iterator())
            out = self._emit(held, last[0] if last is not None else 0, now)
            due, passed = [], []
            for at, v in held:
                gone = (at[1] + 1 + win) * 1000  # no second that is still to come reaches back to this one
                if gone <= now:
                    passed.append(at)
                else:
                    due.append((at[1] + 1) * 1000 if v[3] != "[]" and (at[1] + 1) * 1000 > now else gone)
            if due:
                for at in passed:
                    self.seconds.removeKey(at)
                self.done.update((now,))
                self.handle.registerTimer(min(due))
            else:
                self.seconds.clear()
                self.done.clear()
            return iter(out)

        def _emit(self, held, last, now):
            sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(np.array([v[:3] for _, v in held], np.int64).reshape(-1, 3), axis=0)])
            rows, lo = [], 0
            for at, ((account, sec), v) in enumerate(held):
                while held[lo][0][0] != account or held[lo][0][1] < sec - win:
                    lo += 1
                if v[3] == "[]" or not last < (sec + 1) * 1000 <= now:
                    continue
                n, c, has = (int(x) for x in sums[at + 1] - sums[lo])
                total = Decimal(c).scaleb(-2) if has else None
                for name, us, cents, kept in json.loads(v[3]):
                    rows.append((name, None if account == nobody else account, epoch + pd.Timedelta(sec * 1_000_000 + us, unit="us"),
                                 None if cents is None else Decimal(cents).scaleb(-2), n, total, n >= min_count or (has > 0 and c >= min_cents), kept))
            columns = ["transaction_id", "account_id", "transaction_ts", "amount", "txn_count_5min", "txn_sum_5min", "velocity_flag", "kept"]
            return [pd.DataFrame(rows, columns=columns)] if rows else []

        def close(self) -> None:
            pass

    return Velocity()


VELOCITY_CELL_S = 6 * 3600
VELOCITY_BUCKETS = 256


def velocity_stream(events: DataFrame, params: RiskParams = RiskParams(), delay: str = "30 minutes",
                    ts: str = "transaction_ts", keep: Sequence[str] = (), cell_s: int = VELOCITY_CELL_S,
                    buckets: int = VELOCITY_BUCKETS) -> DataFrame:
    """Exact trailing-window velocity on a stream (equals W2/W3 on replay).

    The state is keyed by (bucket of accounts, cell): time is cut into cells of
    ``cell_s`` seconds, and a row within one window of the next cell's start also
    counts there, as in the batch form, so that a hot account spreads over
    tasks by time; accounts are dealt to ``buckets`` by a hash, since a state key
    of its own for each account and hour costs more than its few rows.  A row
    is emitted once the watermark passes the end of its second, so no later
    in-watermark row can change it.  State is bounded by the watermark delay and
    the window; a batch writes only the seconds it touches.  ``keep`` columns ride
    along with each row (as JSON in the state)
    and come back typed.  State with timers needs the RocksDB store, which is
    set for the session here.
    """
    events.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    win, width = int(params.velocity_window_s), int(cell_s)
    if width < win:
        raise ValueError("cell width must be at least the window length")
    keep = [c for c in keep if c not in ("account_id", "transaction_id", "transaction_ts", "amount",
                                         "event_time")]
    keep_schema = T.StructType([f for f in events.schema.fields if f.name in keep])
    payload = F.to_json(F.struct(*[F.col(c) for c in keep])) if keep else F.lit(None).cast("string")
    # reuse an upstream event-time watermark (e.g. from ``dedup_stream``)
    timed = events if "event_time" in events.columns else \
        events.withColumn("event_time", event_time(ts)).withWatermark("event_time", delay)
    # the state function sees no column names that begin with an underscore
    cell = F.floor(F.col("sec") / F.lit(width)).cast("long")
    near_next = F.col("sec") >= (cell + 1) * F.lit(width) - F.lit(win)
    mine = F.struct(cell.alias("cell"), F.lit(True).alias("own"))
    context = F.struct((cell + 1).alias("cell"), F.lit(False).alias("own"))
    e = timed.select(
        "account_id", "transaction_id", epoch_seconds(ts).alias("sec"),
        ((F.extract(F.lit("SECOND"), F.col(ts)) * 1_000_000).cast("long") % 1_000_000).alias("us"),
        (F.col("amount") * 100).cast("long").alias("cents"), payload.alias("kept"), "event_time")
    e = e.select("*", F.inline(F.when(near_next, F.array(mine, context)).otherwise(F.array(mine))))
    # a context copy needs no payload
    e = e.withColumn("kept", F.when(F.col("own"), F.col("kept")))
    e = e.withColumn("bucket", F.pmod(F.xxhash64("account_id"), F.lit(buckets)))
    processor = velocity_processor(win, int(params.velocity_count), int(params.velocity_amount) * 100)
    out = e.groupBy("bucket", "cell").transformWithStateInPandas(
        processor, VELOCITY_OUT + ", kept string", "Append", "EventTime")
    if not keep:
        return out.drop("kept")
    return (out.withColumn("_k", F.from_json("kept", keep_schema))
            .select(*[c for c in out.columns if c != "kept"], *[F.col(f"_k.{c}").alias(c) for c in keep]))


SCORED_FROM = ("transaction_id", "account_id", "transaction_ts", "amount")


def score_rows(v: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame, account_stats: DataFrame,
               params: RiskParams = RiskParams(), stats_max_bytes: int = STATS_BROADCAST_MAX_BYTES) -> DataFrame:
    """Enrichment, outlier test against account statistics, weighted score and
    alert of rows that carry their velocity.

    The statistics grow with the number of accounts: they are broadcast only
    when the stored table is within ``stats_max_bytes``, otherwise joined by a
    shuffle per micro-batch.
    """
    from ledgerline.operators.enrich import enrich
    from ledgerline.operators.scoring import outlier_test, risk_score

    st = account_stats.select(F.col("account_id").alias("_acct"), F.col("n_amt").alias("_n"),
                              F.col("s_amt").alias("_s"), F.col("s_sq").alias("_sq"))
    st = bounded_broadcast(st, stats_max_bytes)
    j = v.join(st, v["account_id"] == st["_acct"], "left")
    j = j.withColumn("amount_outlier_flag", outlier_test(
        F.col("amount"), F.coalesce(F.col("_n"), F.lit(0)), F.col("_s"), F.col("_sq"), params.zscore))
    j = j.drop("_acct", "_n", "_s", "_sq")
    return risk_score(enrich(j, dim_mcc, dim_geo, params), params)


def score_stream(events: DataFrame, dim_mcc: DataFrame, dim_geo: DataFrame, account_stats: DataFrame,
                 params: RiskParams = RiskParams(), delay: str = "30 minutes") -> DataFrame:
    """Real-time risk scoring against statistics that stay as they are while the
    query runs: exact stateful velocity, then ``score_rows``."""
    keep = [c for c in events.columns if c not in SCORED_FROM]
    return score_rows(velocity_stream(events, params, delay, keep=keep), dim_mcc, dim_geo, account_stats, params)


def score_batch(out_path: str, stats_path: str, dim_mcc: DataFrame, dim_geo: DataFrame,
                params: RiskParams = RiskParams()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body that scores each micro-batch with the newest statistics.

    The version is chosen when a batch is first seen, recorded beside the
    output and written with each score, so a replayed batch gives the same
    scores although the statistics have moved on.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        chosen = f"{out_path.rstrip('/')}_versions/batch_id={batch_id}"
        if not path_exists(spark, chosen + "/_SUCCESS"):
            newest = spark.createDataFrame([(statistics.latest(spark, stats_path),)], "version long")
            newest.coalesce(1).write.mode("overwrite").parquet(chosen)
        version = spark.read.schema("version long").parquet(chosen).first()["version"]
        scored = score_rows(batch, dim_mcc, dim_geo, statistics.read(spark, stats_path, version), params)
        scored = scored.withColumns({"txn_date": F.to_date("transaction_ts"), "stats_version": F.lit(version).cast("long")})
        scored.write.mode("overwrite").partitionBy("txn_date").parquet(f"{out_path}/batch_id={batch_id}")
    return write


def start_scoring_stream(spark: SparkSession, src_dir: str, out_path: str, dim_mcc: DataFrame,
                         dim_geo: DataFrame, stats_path: str,
                         params: RiskParams = RiskParams(), delay: str = "30 minutes",
                         checkpoint: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         dedup: bool = True) -> StreamingQuery:
    """Real-time path: envelopes -> decode/redact/validate -> exact velocity
    -> enrichment + account statistics -> score, by batch and event date.

    Re-delivered events are dropped within the watermark (one shared
    event-time watermark drives the dedup and the velocity state).  Rows are
    written once the watermark makes their velocity final; a batch replaces
    its own directory, so output is exactly-once.  ``stats_path`` is a versioned
    statistics table (``streaming.statistics``), looked up for every batch.
    """
    from ledgerline.streaming.envelope import split_routed
    decoded = decode_envelope(read_event_stream(spark, src_dir, max_files_per_trigger))
    valid, _ = split_routed(routed(decoded))
    events = valid.select("transaction_id", "account_id", "amount", "transaction_ts", "currency",
                          "mcc_code", "country_code", "channel", "region")
    if dedup:   # at-least-once delivery: first arrival per id within the watermark (S4)
        events = dedup_stream(events, delay)
    keep = [c for c in events.columns if c not in SCORED_FROM]
    v = velocity_stream(events, params, delay, keep=keep)
    ckpt = checkpoint or f"{checkpoint_root(spark).rstrip('/')}/streams/scoring"
    w = (v.writeStream.foreachBatch(score_batch(out_path, stats_path, dim_mcc, dim_geo, params)).outputMode("append")
         .option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
