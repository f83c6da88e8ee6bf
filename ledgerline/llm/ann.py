"""Approximate nearest neighbours by an inverted multi-index.

Each half of a unit vector is quantised by a codebook of its own (k-means on a
hash sample of at most about ``sample`` vectors), so that K centroids a half give
K * K cells.  Every row is indexed: it goes to its cell, and the index is stored
sorted by cell, a folder for each centroid of the first half.

A query walks the pairs of centroids by summed squared distance with a heap, until
the cells passed hold ``budget`` entries.  The cells passed are exactly those
within the distance it ended at, so that one number a query says where to look.  The
budget is set on the data: some hundred queries (``probe``) are compared with every
row, and the budget is the number of entries that reaches ``recall`` of their
neighbours' cells.  Queries are searched in blocks of bounded size, twice: the
nearest cells first, whose k-th cosine is then the floor of what the others must
offer.  Entries are reranked by the cosine of the original vectors in double precision.

No task holds a cell: a task scans its part of the index and keeps k rows a query.
Equal vectors of a batch are scored once, with their smallest ids.  Vectors that are
null, empty, zero or hold null or non-finite components, and rows without a vec_id,
take no part; vectors of different lengths are searched apart.  Rows that repeat a
vec_id are rows of their own, but never neighbours of each other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, staged
from ledgerline.llm.vectors import blocks, first_of_equal, hash_share, lengths, matrices
from ledgerline.runtime import scratch_path

CLOSE = 1e-9  # cosines of a matrix product this near the k-th best are computed exactly


@dataclass(frozen=True)
class IndexParams:
    k: int = 5
    every: int = 50           # queries are the rows whose vec_id this divides
    cell_rows: int = 64       # rows wanted in a cell
    max_centroids: int = 256  # of a half
    sample: int = 16_384      # vectors that the codebooks are fitted on
    rounds: int = 15
    probe: int = 256          # queries that set the budget
    recall: float = 0.97
    first: float = 0.125      # share of the budget that the first search spends
    block: int = 8_192        # queries searched at once
    seed: int = 12


@dataclass
class Codebooks:
    halves: tuple[np.ndarray, np.ndarray]  # [centroid, dim] of each half

    @property
    def cut(self) -> int:
        return self.halves[0].shape[1]

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of unit vectors to the centroids of each half."""
        return squared(x[:, :self.cut], self.halves[0]), squared(x[:, self.cut:], self.halves[1])


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to about 1: no cosine changes, none overflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    if not x.shape[1]:
        return np.zeros((1, 0))
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    c = distinct[np.sort(rng.permutation(len(distinct))[:k])]
    for _ in range(rounds if len(c) < len(distinct) else 0):
        near = squared(x, c).argmin(1)
        n = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        sums = np.add.reduceat(x[order], np.searchsorted(near[order], np.flatnonzero(n)), axis=0) if len(x) else c[:0]
        c[n > 0] = sums / n[n > 0, None]
    return c


def fit(sample: np.ndarray, rows: int, p: IndexParams) -> Codebooks:
    """Codebooks of about sqrt(rows / cell_rows) centroids a half."""
    k = int(min(p.max_centroids, max(1, 2 ** np.round(np.log2(max(1.0, rows / p.cell_rows)) / 2))))
    cut = (sample.shape[1] + 1) // 2
    x = unit(scaled(sample))
    return Codebooks((kmeans(x[:, :cut], k, p.rounds, p.seed), kmeans(x[:, cut:], k, p.rounds, p.seed + 1)))


def walk(d1: np.ndarray, d2: np.ndarray, size: np.ndarray, budgets: list[float]) -> list[float]:
    """Summed distances at which a walk over the cells, nearest first, has passed each of the ``budgets`` (ascending) in entries."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, passed, out = [(a[0] + b[0], 0, 0)], 0, []
    while heap and len(out) < len(budgets):
        far, i, j = heapq.heappop(heap)
        passed += size[o1[i], o2[j]]
        while len(out) < len(budgets) and passed >= budgets[len(out)]:
            out.append(far)
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out + [np.inf] * (len(budgets) - len(out))


# ---- search of one part of the index -----------------------------------------------

@dataclass
class Block:
    ids: np.ndarray
    vecs: np.ndarray
    near: np.ndarray    # cells at a greater summed distance than this ...
    far: np.ndarray     # ... up to this are searched
    floor: np.ndarray   # cosines below this are of no use


class Best:
    """The k best (cosine, smaller vec_id first) entries of each query of a block."""

    def __init__(self, block: Block, k: int):
        self.k, self.floor = k, block.floor.copy()
        self.query, self.id, self.score, self.cell = (np.zeros(0, t) for t in (np.int64, np.int64, np.float64, np.int64))

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray, cell: np.ndarray) -> None:
        q, i, s, c = (np.concatenate(x) for x in ((self.query, query), (self.id, ids), (self.score, score), (self.cell, cell)))
        order = np.lexsort((i, -s, q))
        place = np.arange(len(q)) - np.searchsorted(q[order], q[order])
        order, kth = order[place < self.k], order[place == self.k - 1]
        self.query, self.id, self.score, self.cell = q[order], i[order], s[order], c[order]
        self.floor[q[kth]] = np.maximum(self.floor[q[kth]], s[kth])


def scan(best: Best, block: Block, reach: tuple[np.ndarray, np.ndarray], ids: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, k: int) -> None:
    """Score the rows (``ids``, raw vectors ``x``, cells ``i``, ``j``) against the queries that pass their cells."""
    x = scaled(x)
    norm = np.sqrt((x * x).sum(1))
    cell = i * reach[1].shape[1] + j
    q = scaled(block.vecs)
    q_norm = np.sqrt((q * q).sum(1))
    order = np.argsort(cell, kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
        far = reach[0][:, i[at[0]]] + reach[1][:, j[at[0]]]
        who = np.flatnonzero((far > block.near) & (far <= block.far))
        step = max(1, (1 << 22) // max(1, len(who)))
        for s in range(0, len(at) if len(who) else 0, step):
            rows = at[s:s + step]
            score = (q[who] / q_norm[who, None]) @ (x[rows] / norm[rows, None]).T
            score[block.ids[who][:, None] == ids[rows]] = -np.inf
            bar = best.floor[who] - CLOSE
            if len(rows) > k:
                bar = np.maximum(bar, np.partition(score, len(rows) - k, axis=1)[:, -k] - CLOSE)
            u, v = np.nonzero(score >= np.maximum(bar, -2.0)[:, None])
            a, b = who[u], rows[v]
            exact = (q[a] * x[b]).sum(1) / (q_norm[a] * norm[b])
            best.add(a, ids[b], exact, cell[b])


def search(index: DataFrame, block: Block, books: Codebooks, p: IndexParams, path: str) -> DataFrame:
    """query (its place in the block), vec_id, score, cell: k candidates a task and query, stored at ``path``."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast((block, books))  # bounded by ``block`` queries
    d1, d2 = books.distances(unit(scaled(block.vecs)))
    slabs = np.flatnonzero((d1 + d2.min(1, keepdims=True) <= block.far[:, None]).any(0)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, codes = shared.value
        reach, best = codes.distances(unit(scaled(mine.vecs))), Best(mine, p.k)
        for b in batches:
            ids, x = b.column("vec_id").to_numpy(), np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float64).reshape(b.num_rows, -1)
            keep = first_of_equal(x, ids, p.k)
            i, j = (b.column(c).to_numpy().astype(np.int64)[keep] for c in ("slab", "tile"))
            scan(best, mine, reach, ids[keep], x[keep], i, j, p.k)
        yield pa.RecordBatch.from_arrays([pa.array(best.query), pa.array(best.id), pa.array(best.score), pa.array(best.cell)], ["query", "vec_id", "score", "cell"])

    schema = T.StructType([T.StructField("query", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("cell", T.LongType())])
    index.where(F.col("slab").isin(slabs)).select("vec_id", "vec", "slab", "tile").mapInArrow(run, schema).write.parquet(path)
    shared.unpersist()
    return spark.read.schema(schema).parquet(path)


# ---- the operator -----------------------------------------------------------------

def usable(rows: DataFrame, size: int) -> DataFrame:
    """vec_id and vec (its components as doubles) of the vectors of one length that take part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in matrices(b.column("embedding")):
                at, x = at[x.any(1)], x[x.any(1)]
                yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(at)).cast(pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], ["vec_id", "vec"])

    return rows.where((F.size("embedding") == size) & F.col("vec_id").isNotNull()).select("vec_id", "embedding").mapInArrow(run, "vec_id long, vec binary")


def _matrix(rows: list, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(r["vec"]) for r in rows), np.float64).reshape(len(rows), size)


def _kth(found: DataFrame, k: int) -> list:
    """query, floor of the queries of a block that have k candidates; at most one row a query."""
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).where(F.col("place") == k).select("query", F.col("score").alias("floor")).collect()


def nearest(rows: DataFrame, p: IndexParams = IndexParams()) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row."""
    ship(rows.sparkSession)
    schema = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    out = rows.sparkSession.createDataFrame([], schema)
    for size in lengths(rows, "embedding"):
        out = out.unionByName(_nearest_of_length(rows, size, p))
    return out


def _nearest_of_length(rows: DataFrame, size: int, p: IndexParams) -> DataFrame:
    spark = rows.sparkSession
    vecs = staged(usable(rows, size), "ann-vectors")
    n = vecs.count()
    sample = vecs.where(hash_share(n, p.sample, "vec_id", "vec", seed=p.seed)).limit(2 * p.sample).collect()  # bounded
    sample = sample or vecs.limit(1).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = fit(_matrix(sample, size), n, p)
    code = spark.sparkContext.broadcast(books)  # bounded: 2 * max_centroids half vectors

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float64).reshape(b.num_rows, -1)
            d1, d2 = code.value.distances(unit(scaled(x)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), pa.array(d1.argmin(1).astype(np.int32)), pa.array(d2.argmin(1).astype(np.int32))], ["vec_id", "vec", "slab", "tile"])

    path = scratch_path(spark, "ann-index")
    placed = vecs.mapInArrow(place, "vec_id long, vec binary, slab int, tile int")
    # ties of a hot cell are spread by the hash
    by_cell = ("slab", "tile", F.xxhash64("vec_id", "vec"))
    placed.repartitionByRange(*by_cell).sortWithinPartitions("slab", "tile").write.partitionBy("slab").parquet(path)
    index = spark.read.schema("vec_id long, vec binary, tile int, slab int").parquet(path)
    sizes = np.zeros((len(books.halves[0]), len(books.halves[1])), np.int64)
    for r in index.groupBy("slab", "tile").agg(F.approx_count_distinct("vec").alias("n")).collect():  # a row a cell
        sizes[r["slab"], r["tile"]] = max(1, r["n"])

    asked = index.where(F.pmod("vec_id", F.lit(p.every)) == 0)
    n_asked = asked.count()
    probes = asked.where(hash_share(n_asked, p.probe, "vec_id", "vec", seed=p.seed + 1)).limit(2 * p.probe).collect() or asked.limit(1).collect()  # bounded
    if not probes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    budget = _budget(index, probes, books, sizes, size, p)
    steps = spark.sparkContext.broadcast((books, sizes, [budget * p.first, budget]))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, entries, budgets = steps.value
        for b in batches:
            x = np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float64).reshape(b.num_rows, -1)
            ends = np.array([walk(d1, d2, entries, budgets) for d1, d2 in zip(*codes.distances(unit(scaled(x))))])
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vec"), pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["vec_id", "vec", "near", "far"])

    queries = scratch_path(spark, "ann-queries")
    near_queries = asked.select("vec_id", "vec", "slab", "tile").repartitionByRange(-(-n_asked // p.block), *by_cell)
    near_queries.select("vec_id", "vec").mapInArrow(reach, "vec_id long, vec binary, near double, far double").write.option("maxRecordsPerFile", p.block).parquet(queries)
    kind = "vec_id long, vec binary, near double, far double"  # one file holds at most ``block`` queries
    found, keys = scratch_path(spark, "ann-found"), scratch_path(spark, "ann-keys")
    for at, got in enumerate(blocks(spark, queries, kind, p.block)):  # queries that lie near each other
        spark.createDataFrame([(i, r["vec_id"]) for i, r in enumerate(got)], "query long, query_id long").write.parquet(f"{keys}/block={at}")
        ids, near, far = (np.array([r[c] for r in got]) for c in ("vec_id", "near", "far"))
        block = Block(ids, _matrix(got, size), np.full(len(got), -1.0), near, np.full(len(got), -2.0))
        first = search(index, block, books, p, f"{found}/block={at}/part=0")
        for r in _kth(first, p.k):
            block.floor[r["query"]] = r["floor"]
        block.near, block.far = near, far
        search(index, block, books, p, f"{found}/block={at}/part=1")
    hits = spark.read.schema("query long, vec_id long, score double, block int").parquet(found)
    rank = F.row_number().over(Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id"))
    best = hits.select("block", "query", "vec_id", "score", rank.alias("rank")).where(F.col("rank") <= p.k)
    named = spark.read.schema("query long, query_id long, block int").parquet(keys)
    return best.join(named, ["block", "query"]).select("query_id", "rank", "vec_id", "score")


def _budget(index: DataFrame, probes: list, books: Codebooks, sizes: np.ndarray, size: int, p: IndexParams) -> float:
    """Entries that a walk must pass to reach the cells of ``recall`` of the probes' true neighbours."""
    n, spark = len(probes), index.sparkSession
    block = Block(np.array([r["vec_id"] for r in probes]), _matrix(probes, size), np.full(n, -1.0), np.full(n, np.inf), np.full(n, -2.0))
    found = search(index, block, books, p, scratch_path(spark, "ann-probe"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    true = found.withColumn("rank", rank).where(F.col("rank") <= p.k).collect()  # k rows a probe
    if not true:
        return 1.0
    d1, d2 = books.distances(unit(scaled(block.vecs)))
    need = []
    for r in true:
        far = d1[r["query"]][:, None] + d2[r["query"]][None, :]
        need.append(int(sizes[far <= far.reshape(-1)[r["cell"]]].sum()))
    return float(np.quantile(need, p.recall, method="higher"))
