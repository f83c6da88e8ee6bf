"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine at least c are within a squared distance of 2 (1 - c).
The vectors are rotated by a fixed random rotation, which spreads the distance
evenly, and cut into blocks of ``block_dims`` coordinates.  If every block were
further apart than its share of the squared distance, the whole would be, so
each link shows up in at least one block: no link is lost.

For each block the space is cut into the leaves of a k-d tree (medians of a
bounded sample).  A vector goes to its leaf, and to those pairs of leaves whose
other box lies within the block's budget.  One group joins one pair of leaves; a
pair of vectors is handled in the first block that finds it, and verified by the
cosine of the original vectors in double precision.  A group returns link counts
for each vector and a spanning forest of its links, never all pairs.

Equal vectors are joined once, with their number of copies.  Vectors of different
lengths are never linked; each length that occurs is joined apart.  Vectors that are
null, empty, zero or hold a null or non-finite component, and vectors without a
vec_id link with nothing: n_links 0, a component of their own (null for a null
vec_id), kept.  Rows that repeat a vec_id are vectors of their own in the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, staged
from ledgerline.llm.components import components
from ledgerline.llm.simhash import Forest
from ledgerline.llm.vectors import hash_share, matrices


@dataclass(frozen=True)
class EmbeddingParams:
    cosine: float = 0.95
    block_dims: int = 8
    leaf_rows: int = 4_096       # vectors wanted in a leaf
    max_leaves: int = 256
    sample: int = 16_384         # vectors from which the trees are cut
    seed: int = 11


@dataclass
class Blocks:
    rotation: np.ndarray
    edges: list[tuple[int, int]]          # columns of each block
    budget: list[float]                   # squared distance of each block
    low: list[np.ndarray]                 # [leaf, dim] of each block
    high: list[np.ndarray]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cut(sample: np.ndarray, rows: int, p: EmbeddingParams) -> Blocks:
    """Rotation, blocks and k-d leaves; ``rows``: vectors that will be joined."""
    d = sample.shape[1]
    q, r = np.linalg.qr(np.random.default_rng(p.seed).normal(size=(d, d)))
    out = Blocks(q * np.sign(np.diag(r)), [], [], [], [])
    rotated = unit(sample) @ out.rotation if len(sample) else sample
    depth = max(0, int(np.ceil(np.log2(max(1, min(p.max_leaves, rows / p.leaf_rows))))))
    for a in range(0, d, p.block_dims):
        b = min(d, a + p.block_dims)
        out.edges.append((a, b))
        out.budget.append(2 * (1 - p.cosine) * (b - a) / d * (1 + 1e-6) + 1e-12)
        leaves = [(rotated[:, a:b], np.full(b - a, -np.inf), np.full(b - a, np.inf))]
        for _ in range(depth):
            leaves = [half for pts, lo, hi in leaves for half in _halve(pts, lo, hi)]
        out.low.append(np.array([x[1] for x in leaves]))
        out.high.append(np.array([x[2] for x in leaves]))
    return out


def _halve(pts: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list:
    k = int(np.argmax(pts.std(0))) if len(pts) else 0
    at = float(np.median(pts[:, k])) if len(pts) else 0.0
    at = min(max(at, lo[k]), hi[k])
    left, right = hi.copy(), lo.copy()
    left[k] = right[k] = at
    return [(pts[pts[:, k] < at], lo, left), (pts[pts[:, k] >= at], right, hi)]


def _home(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    inside = ((x[:, None, :] >= low) & (x[:, None, :] < high)).all(2)
    return inside.argmax(1)


def deal(rotated: np.ndarray, blocks: Blocks) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, row, first leaf, second leaf, whether the row lives in the second) of every group a vector goes to."""
    for j, (a, b) in enumerate(blocks.edges):
        x = rotated[:, a:b]
        home = _home(x, blocks.low[j], blocks.high[j])
        gap = np.maximum(0, np.maximum(blocks.low[j] - x[:, None, :], x[:, None, :] - blocks.high[j]))
        near = (gap * gap).sum(2) <= blocks.budget[j]
        near[np.arange(len(x)), home] = True
        row, leaf = np.nonzero(near)
        h = home[row]
        yield j, row, np.minimum(h, leaf), np.maximum(h, leaf), h > leaf


def linked_pairs(a: np.ndarray, b: np.ndarray, j: int, blocks: Blocks, cosine: float, same: bool, at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors a and b (``same``: of one set, i < k) that block j is the first to find and the cosine confirms."""
    ra, rb = a @ blocks.rotation, b @ blocks.rotation
    lo, hi = blocks.edges[j]
    xa, xb = ra[:, lo:hi], rb[:, lo:hi]
    na, nb = (xa * xa).sum(1), (xb * xb).sum(1)
    step = max(1, (1 << 22) // max(1, len(b)))
    for s in range(0, len(a), step):
        dist = na[s:s + step, None] + nb - 2 * (xa[s:s + step] @ xb.T)
        i, k = np.nonzero(dist <= blocks.budget[j] * (1 + 1e-9) + 1e-12)
        i += s
        if same:
            i, k = i[i < k], k[i < k]
        for t in range(0, len(i), at_once):
            u, v = i[t:t + at_once], k[t:t + at_once]
            for e in range(j + 1):
                c, d = blocks.edges[e]
                diff = ra[u, c:d] - rb[v, c:d]
                found = (diff * diff).sum(1) <= blocks.budget[e]
                keep = found if e == j else ~found
                u, v = u[keep], v[keep]
            if len(u):
                linked = np.einsum("ij,ij->i", a[u], b[v]) >= cosine
                if linked.any():
                    yield u[linked], v[linked]


def _join_group(g: pd.DataFrame, blocks: Blocks, p: EmbeddingParams, kind: str) -> pd.DataFrame:
    j, second = int(g["block"].iloc[0]), g["second"].to_numpy()
    same = int(g["a"].iloc[0]) == int(g["b"].iloc[0])
    x = unit(np.frombuffer(b"".join(g["vec"]), kind).reshape(len(g), -1))
    order = np.argsort(second, kind="stable")
    x, node, copies = x[order], g["node"].to_numpy()[order], g["copies"].to_numpy()[order]
    n = int((~second).sum())
    a, b, shift = (x, x, 0) if same else (x[:n], x[n:], n)
    links, forest = np.zeros(len(x)), Forest(len(x))
    for u, v in linked_pairs(a, b, j, blocks, p.cosine, same):
        v = v + shift
        links += np.bincount(u, copies[v], len(x)) + np.bincount(v, copies[u], len(x))
        forest.add(u, v)
    u, v = forest.edges()
    some = links > 0
    return pd.DataFrame({"u": np.concatenate([node[some], node[u]]), "v": pd.array([None] * int(some.sum()) + node[v].tolist(), "Int64"),
                         "n": np.concatenate([links[some].astype(np.int64), np.zeros(len(u), np.int64)])})


def usable(rows: DataFrame) -> tuple[DataFrame, str]:
    """vec_id and vec (its bytes, null if it links with nothing), and their number format."""
    double = isinstance(rows.schema["embedding"].dataType.elementType, T.DoubleType)
    kind = "<f8" if double else "<f4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[bytes | None] = [None] * b.num_rows
            for at, x in matrices(b.column("embedding")):
                for n, v in zip(at.tolist(), x.astype(kind) + 0.0):  # no negative zeros
                    out[n] = v.tobytes() if np.isfinite(v).all() and v.any() else None
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "vec"])

    ship(rows.sparkSession)
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("vec", T.BinaryType())])
    return rows.select("vec_id", "embedding").mapInArrow(run, schema), kind


def near_duplicates(rows: DataFrame, p: EmbeddingParams = EmbeddingParams()) -> DataFrame:
    """vec_id, n_links, component_id, kept of each vector."""
    vecs, kind = usable(rows)
    vecs = staged(vecs, "vec-rows")
    joins = F.col("vec").isNotNull() & F.col("vec_id").isNotNull()
    out = vecs.where(~joins).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    size = F.octet_length("vec")
    for r in vecs.where(joins).select(size.alias("n")).distinct().orderBy("n").collect():  # a row a length
        out = _of_length(vecs.where(joins & (size == r["n"])), kind, r["n"] // np.dtype(kind).itemsize, p).union(out)
    return out


def _of_length(vecs: DataFrame, kind: str, d: int, p: EmbeddingParams) -> DataFrame:
    spark = vecs.sparkSession
    distinct = staged(vecs.groupBy("vec").agg(F.min("vec_id").cast("long").alias("node"), F.count("*").alias("copies")), "vec-distinct")
    n = distinct.count()
    sample = distinct.where(hash_share(n, p.sample, "vec", seed=p.seed)).limit(2 * p.sample).select("vec").collect()  # bounded
    points = np.frombuffer(b"".join(bytes(r[0]) for r in sample), kind).reshape(len(sample), d) if sample else np.zeros((0, d))
    shared = spark.sparkContext.broadcast(cut(points, n, p))

    def to_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                x = unit(np.frombuffer(b"".join(b.column("vec").to_pylist()), kind).reshape(b.num_rows, -1))
                for j, row, first, second, is_second in deal(x @ shared.value.rotation, shared.value):
                    got = b.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), j, np.int32)), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), pa.array(is_second),
                                                      *(got.column(c) for c in ("vec", "node", "copies"))], ["block", "a", "b", "second", "vec", "node", "copies"])

    dealt = distinct.mapInArrow(to_groups, "block int, a int, b int, second boolean, vec binary, node long, copies long")
    found = staged(dealt.groupBy("block", "a", "b").applyInPandas(lambda g: _join_group(g, shared.value, p, kind), "u long, v long, n long"), "vec-links")
    roots = components(found.where("v is not null").select("u", "v"))
    links = found.where("v is null").groupBy("u").agg(F.sum("n").alias("n"))
    member = (distinct.join(links, F.col("node") == F.col("u"), "left").drop("u").join(roots.withColumnRenamed("node", "r"), F.col("node") == F.col("r"), "left")
              .select("vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")))
    member = staged(member, "vec-member")
    return vecs.join(member, "vec").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
