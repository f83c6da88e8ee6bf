"""Hard-negative mining with segment summaries.

A row stores, for each segment of its vector, the mean and the deviation.  With
``L`` components in a segment, the inner product of two vectors over it lies within

    L * mean_x * mean_y  +-  L * dev_x * dev_y        (Cauchy-Schwarz on what the means leave)

so the sums over the segments bound the whole product.  Pairs of an anchor and a row
are tested with long segments first; only those that may still reach a place
among the anchor's best are refined with shorter segments, and only what is left is
multiplied out.  Products are of integers and exact.

Anchors are searched in blocks of bounded size against all rows, each row
in its own task's part: first for the positives (same label), then for the
negatives (other label, scores in a window under each positive).  Each search takes a
small share of the rows first; the k-th scores found there bound what the rest
must offer, so that what a task returns does not grow with the number of tasks.
No group of rows of one label is ever collected.

Rows with a null label, a null or empty vector, or a null or non-finite component
take no part, nor do rows without a vec_id or with a scaled component of 2^24 or
more in size, whose products could leave 64 bits.  Vectors of different lengths are
searched apart.  Rows that repeat a vec_id are rows of their own; a row is never
compared with one of its own vec_id.  An anchor without positives or without
negatives in the window gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, staged
from ledgerline.llm.vectors import blocks, first_of_equal, lengths, matrices
from ledgerline.runtime import scratch_path

LEAST, MOST = -(1 << 62), 1 << 62
TOO_LARGE = float(1 << 24)


@dataclass(frozen=True)
class NegativeParams:
    anchors: int = 100                     # rows whose vec_id this divides
    positives: int = 5
    negatives: int = 10
    low: int = 30                          # a negative's score lies within these per cent of the positive's
    high: int = 90
    scale: float = 256.0
    segments: tuple[int, ...] = (16, 4)    # components of a segment, longest first; each divides the one before
    first: int = 16                        # one of so many rows is searched first
    block: int = 8_192                     # anchors searched at once
    dense: float = 0.15                    # share of pairs from which a whole matrix is cheaper than single pairs


# ---- summaries and bounds ----------------------------------------------------------

def summary(x: np.ndarray, length: int) -> np.ndarray:
    """Means, then deviations, of each segment, both times the root of its length."""
    at = np.arange(0, x.shape[1], length)
    n = np.diff(np.append(at, x.shape[1]))
    mean = np.add.reduceat(x, at, axis=1) / n
    off = x - np.repeat(mean, n, axis=1)
    return np.concatenate([mean * np.sqrt(n), np.sqrt(np.add.reduceat(off * off, at, axis=1))], 1)


def bounds(a: np.ndarray, b: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) inner products of every pair with summaries ``a`` and ``b``; ``slack`` covers their rounding."""
    s = a.shape[1] // 2
    middle, spread = a[:, :s] @ b[:, :s].T, a[:, s:] @ b[:, s:].T + slack
    return middle - spread, middle + spread


def pair_bounds(a: np.ndarray, b: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a.shape[1] // 2
    middle, spread = np.einsum("ij,ij->i", a[:, :s], b[:, :s]), np.einsum("ij,ij->i", a[:, s:], b[:, s:]) + slack
    return middle - spread, middle + spread


def window(positive: np.ndarray, p: NegativeParams) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores n with low * positive <= 100 * n <= high * positive."""
    tens, rest = positive // 100, positive % 100
    return tens * p.low - (-rest * p.low // 100), tens * p.high + rest * p.high // 100


# ---- search of one part of the rows ------------------------------------------------

@dataclass
class Anchors:
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray           # [anchor, dim] integers
    low: np.ndarray         # [anchor, window] least score of use
    high: np.ndarray        # [anchor, window] greatest


class Places:
    """The k best (score, smaller vec_id first) rows of each window of each anchor."""

    def __init__(self, anchors: Anchors, k: int):
        self.k, self.low, self.high, self.width = k, anchors.low.copy(), anchors.high, anchors.low.shape[1]
        self.place, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))

    def reach(self, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of use to each anchor."""
        dead = self.low[who] > self.high[who]
        return np.where(dead, MOST, self.low[who]).min(1), np.where(dead, LEAST, self.high[who]).max(1)

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        got = [(self.place, self.id, self.score)]
        for w in range(self.width):
            fits = (score >= self.low[anchor, w]) & (score <= self.high[anchor, w])
            got.append((anchor[fits] * self.width + w, ids[fits], score[fits]))
        place, i, s = (np.concatenate(x) for x in zip(*got))
        order = np.lexsort((i, -s, place))
        nth = np.arange(len(order)) - np.searchsorted(place[order], place[order])
        kth, order = order[nth == self.k - 1], order[nth < self.k]
        self.place, self.id, self.score = place[order], i[order], s[order]
        a, w = np.divmod(place[kth], self.width)
        self.low[a, w] = np.maximum(self.low[a, w], s[kth])

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, vec_id, score) in any window, with the repeats of a window that holds most."""
        order = np.lexsort((self.place, self.score, self.id, self.place // self.width))
        a, i, s, p = self.place[order] // self.width, self.id[order], self.score[order], self.place[order]
        if not len(a):
            return a, i, s
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (i[1:] != i[:-1]) | (s[1:] != s[:-1])])
        new_place = new | np.concatenate([[True], p[1:] != p[:-1]])
        at = np.arange(len(a))
        repeat = at - np.maximum.accumulate(np.where(new_place, at, 0))
        # the n-th repeat of a row counts once, whatever windows hold it
        number = np.cumsum(new)
        first = np.unique(np.stack([number, repeat]), axis=1, return_index=True)[1]
        return a[first], i[first], s[first]


def products(a: np.ndarray, b: np.ndarray, pairs: bool) -> np.ndarray:
    """Exact inner products: in doubles where no sum can leave 53 bits, else in 64-bit integers."""
    size = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float64 if size < 2.0 ** 53 else np.int64
    x, y = a.astype(kind), b.astype(kind)
    return (np.einsum("ij,ij->i", x, y) if pairs else x @ y.T).astype(np.int64)


def scan(places: Places, anchors: Anchors, sums: list[np.ndarray], norm: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray,
         rows_sums: list[np.ndarray], same: bool, p: NegativeParams, at_once: int = 1 << 20) -> None:
    """Let the rows compete for the anchors' places; ``sums`` are summaries from the longest segments to the shortest."""
    row_norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        who = np.flatnonzero((anchors.labels == label) == same)
        step = max(1, at_once // max(1, len(mine)))
        for s in range(0, len(who), step):
            a = who[s:s + step]
            low, high = places.reach(a)
            a, low, high = a[low <= high], low[low <= high], high[low <= high]
            if not len(a):
                continue
            slack = norm[a] * (2e-6 * row_norm[mine].max()) + 0.01
            alive = anchors.ids[a][:, None] != ids[mine]
            u = v = None
            for mine_sums, their_sums in zip(sums, rows_sums):
                if u is None:
                    least, most = bounds(mine_sums[a], their_sums[mine], slack[:, None])
                    alive &= (most >= low[:, None]) & (least <= high[:, None])
                    if alive.mean() < p.dense:
                        u, v = np.nonzero(alive)
                else:
                    least, most = pair_bounds(mine_sums[a[u]], their_sums[mine[v]], slack[u])
                    ok = (most >= low[u]) & (least <= high[u])
                    u, v = u[ok], v[ok]
            if u is None:
                score = products(anchors.x[a], x[mine], False)
                u, v = np.nonzero(alive & (score >= low[:, None]) & (score <= high[:, None]))
                score = score[u, v]
            else:
                score = products(anchors.x[a[u]], x[mine[v]], True)
            places.add(a[u], ids[mine[v]], score)


def search(rows: DataFrame, anchors: Anchors, same: bool, k: int, size: int, p: NegativeParams, path: str) -> DataFrame:
    """anchor (its place in the block), vec_id, score: candidates for the places of each anchor's windows."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(anchors)  # bounded by ``block`` anchors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shared.value
        places, exact = Places(mine, k), mine.x.astype(np.float64)
        sums, norm = [summary(exact, n) for n in p.segments], np.sqrt((exact * exact).sum(1))
        for b in batches:
            ids, labels = b.column("vec_id").to_numpy(), b.column("label").to_numpy()
            x, s = (np.frombuffer(b"".join(b.column(c).to_pylist()), kind).reshape(b.num_rows, -1) for c, kind in (("vec", np.int32), ("sums", np.float32)))
            keep = first_of_equal(np.concatenate([labels.astype(np.int64).view(np.int32).reshape(-1, 2), x], 1), ids, k)
            ends = np.cumsum([0] + [2 * -(-size // n) for n in p.segments])
            stored = [s[keep, lo:hi].astype(np.float64) for lo, hi in zip(ends[:-1], ends[1:])]
            scan(places, mine, sums, norm, ids[keep], labels[keep], x[keep], stored, same, p)
        a, i, score = places.distinct()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(i), pa.array(score)], ["anchor", "vec_id", "score"])

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "vec_id", "score")])
    rows.select("vec_id", "label", "vec", "sums").mapInArrow(run, schema).write.parquet(path)
    shared.unpersist()
    return spark.read.schema(schema).parquet(path)


# ---- the operator --------------------------------------------------------------------

def usable(rows: DataFrame, size: int, p: NegativeParams) -> DataFrame:
    """vec_id, label, vec (32-bit integers), sums (summaries) and turn (0: searched first) of the rows of one length that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in matrices(b.column("embedding")):
                with np.errstate(over="ignore"):
                    x = np.floor(p.scale * x)
                fits = (np.abs(x) < TOO_LARGE).all(1)
                at, x = pa.array(at[fits]), x[fits]
                sums = np.concatenate([summary(x, n) for n in p.segments], 1).astype(np.float32)
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(at).cast(pa.int64()) for c in ("vec_id", "label")), pa.array([v.tobytes() for v in x.astype(np.int32)], pa.binary()),
                                                  pa.array([v.tobytes() for v in sums], pa.binary())], ["vec_id", "label", "vec", "sums"])

    part = rows.where((F.size("embedding") == size) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select("vec_id", "label", "embedding")
    out = part.mapInArrow(run, "vec_id long, label long, vec binary, sums binary")
    return out.withColumn("turn", F.when(F.pmod(F.xxhash64("vec_id", "vec"), F.lit(p.first)) == 0, 0).otherwise(1))


def mine(rows: DataFrame, p: NegativeParams = NegativeParams()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    ship(rows.sparkSession)
    out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for size in lengths(rows, "embedding"):
        out = out.unionByName(_mine_length(rows, size, p))
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each anchor, with their rank."""
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _in_windows(found: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """The k best candidates in each window (anchor, nth, low, high) of an anchor, with their rank."""
    hit = found.join(F.broadcast(windows), "anchor").where(F.col("score").between(F.col("low"), F.col("high")))
    place = F.row_number().over(Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "vec_id"))
    return hit.withColumn("rank", place).where(F.col("rank") <= k)


def _mine_length(rows: DataFrame, size: int, p: NegativeParams) -> DataFrame:
    spark = rows.sparkSession
    path, asked_at = scratch_path(spark, "negatives-rows"), scratch_path(spark, "negatives-anchors")
    usable(rows, size, p).write.partitionBy("turn").parquet(path)
    stored = spark.read.schema("vec_id long, label long, vec binary, sums binary, turn int").parquet(path)
    turns = [stored.where(F.col("turn") == t) for t in (0, 1)]
    kind = "vec_id long, label long, vec binary"
    stored.where(F.pmod("vec_id", F.lit(p.anchors)) == 0).select("vec_id", "label", "vec").write.option("maxRecordsPerFile", p.block).parquet(asked_at)
    pairs, hits = scratch_path(spark, "negatives-positives"), scratch_path(spark, "negatives-hits")
    done = False
    for at, got in enumerate(blocks(spark, asked_at, kind, p.block)):
        done = True
        ids, labels = (np.array([r[c] for r in got], np.int64) for c in ("vec_id", "label"))
        x = np.frombuffer(b"".join(bytes(r["vec"]) for r in got), np.int32).reshape(len(got), size)
        anchors = Anchors(ids, labels, x, np.full((len(got), 1), LEAST), np.full((len(got), 1), MOST))
        first = search(turns[0], anchors, True, p.positives, size, p, scratch_path(spark, "negatives-first"))
        for r in _best(first, p.positives).where(F.col("rank") == p.positives).collect():  # one row an anchor of the block
            anchors.low[r["anchor"], 0] = r["score"]
        rest = search(turns[1], anchors, True, p.positives, size, p, scratch_path(spark, "negatives-rest"))
        positives = _best(first.union(rest), p.positives).collect()  # some rows an anchor of the block
        low, high = np.full((len(got), p.positives), MOST), np.full((len(got), p.positives), LEAST)
        if positives:
            a, n, score = (np.array([r[c] for r in positives], np.int64) for c in ("anchor", "rank", "score"))
            low[a, n - 1], high[a, n - 1] = window(score, p)
        named = [(int(r["anchor"]), int(r["rank"]), int(ids[r["anchor"]]), r["vec_id"], r["score"], int(low[r["anchor"], r["rank"] - 1]), int(high[r["anchor"], r["rank"] - 1])) for r in positives]
        windows = staged(spark.createDataFrame(named, "anchor long, nth int, anchor_id long, positive_id long, positive_score long, low long, high long"), "negatives-windows")
        anchors = Anchors(ids, labels, x, low, high)
        first = search(turns[0], anchors, False, p.negatives, size, p, scratch_path(spark, "negatives-first"))
        raised = low.copy()
        for r in _in_windows(first, windows, p.negatives).where(F.col("rank") == p.negatives).select("anchor", "nth", "score").collect():
            raised[r["anchor"], r["nth"] - 1] = r["score"]
        rest = search(turns[1], Anchors(ids, labels, x, raised, high), False, p.negatives, size, p, scratch_path(spark, "negatives-rest"))
        _in_windows(first.union(rest), windows, p.negatives).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")) \
            .write.parquet(f"{hits}/block={at}")
    if not done:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return (spark.read.schema("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, block int").parquet(hits).drop("block"))
