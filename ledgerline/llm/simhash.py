"""SimHash near-duplicates by a binary-trie self-join of the fingerprints.

Fingerprint: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``words`` consecutive words joined by a space (fewer words: the whole sequence),
XXH64 (seed 42) of each, repeats included; a bit is 1 if set in over half of
the hashes.  A text without a word (also null) has fingerprint zero and links
like any other.

Join: the distinct fingerprints are cut into the leaves of a binary trie over
their leading bits (a hot prefix is cut deeper).  The driver traverses pairs of
trie nodes from the root, adding up differing bits, and keeps the leaf pairs
within the error budget; both are bounded by ``max_leaves``.  Each leaf pair is
one group in which the traversal goes on bit by bit below the leaves, pruning
node pairs whose accumulated difference exceeds the budget.  A group returns a
spanning forest of its links, never all pairs, and the components of the forests
are found by star contraction.

Copies meet in one fingerprint before any join.  Rows that repeat a doc_id are
told apart by nothing and share its component; a null doc_id gets a fingerprint
and component but never names one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, slices, staged, texts
from ledgerline.llm.components import components


@dataclass(frozen=True)
class SimHashParams:
    words: int = 3
    max_bits: int = 3
    leaf_rows: int = 16_384       # fingerprints wanted in a trie leaf
    min_leaves: int = 64
    max_leaves: int = 4_096
    histogram_bits: int = 16      # the leaves are cut from counts of this many leading bits


def fingerprint(text: bytes, words: int = 3) -> int:
    """64-bit SimHash of one whole text."""
    w = text.lower().split()
    if not w:
        return 0
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        return h(b" ".join(w), 42)
    flat = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = [0, *ends[: len(w) - words].tolist()]
    stops = (ends[words - 1:] - 1).tolist()
    hashes = np.array([h(flat[a:b], 42) for a, b in zip(starts, stops)], ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, columns ``more`` and fp (the fingerprint's 64 bits as a signed long) of each row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, words) for t in texts(b)], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in named), pa.array(fp.view(np.int64))], [*named, "fp"])

    named = ["doc_id", *more]
    schema = T.StructType([*(T.StructField(c, docs.schema[c].dataType) for c in named), T.StructField("fp", T.LongType())])
    return docs.select(*named, "text").mapInArrow(run, schema)


# ---- the top of the trie, on the driver: bounded by max_leaves -------------

def cut_leaves(counts: dict[int, int], p: SimHashParams) -> list[tuple[int, int]]:
    """Trie leaves (depth, prefix), by halving the fullest node until all are small."""
    total = sum(counts.values())
    want = min(p.max_leaves, max(p.min_leaves, -(-total // p.leaf_rows)))
    top = p.histogram_bits
    width = np.zeros(1 << top, np.int64)
    for prefix, n in counts.items():
        width[prefix] = n
    below = np.concatenate([[0], np.cumsum(width)])
    size = lambda d, x: int(below[(x + 1) << (top - d)] - below[x << (top - d)])
    import heapq
    heap, done = [(-total, 0, 0)], []
    while heap and len(heap) + len(done) < want:
        n, d, x = heapq.heappop(heap)
        if d == top:
            done.append((d, x))
            continue
        for child in (2 * x, 2 * x + 1):
            heapq.heappush(heap, (-size(d + 1, child), d + 1, child))
    return sorted(done + [(d, x) for _, d, x in heap])


def leaf_pairs(leaves: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Indices of leaf pairs (first <= second) whose prefixes differ in at most ``budget`` bits."""
    at = {leaf: i for i, leaf in enumerate(leaves)}
    out = []
    stack = [((0, 0), (0, 0), 0)]
    kids = lambda n: [n] if n in at else [(n[0] + 1, 2 * n[1]), (n[0] + 1, 2 * n[1] + 1)]
    while stack:
        a, b, _ = stack.pop()
        d = min(a[0], b[0])
        if (a[1] >> (a[0] - d) ^ b[1] >> (b[0] - d)).bit_count() > budget:
            continue
        if a in at and b in at:
            out.append((at[a], at[b]))
        elif a == b:
            x, y = kids(a)
            stack += [(x, x, 0), (x, y, 0), (y, y, 0)]
        elif b not in at and (a in at or b[0] <= a[0]):
            stack += [(a, y, 0) for y in kids(b)]
        else:
            stack += [(x, b, 0) for x in kids(a)]
    return sorted({(min(x), max(x)) for x in out})


# ---- below a leaf pair, in a task ------------------------------------------

def trie_pairs(a: np.ndarray, b: np.ndarray, budget: int, at_once: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with at most ``budget`` differing bits between a[i] and b[j].

    ``a`` and ``b``: sorted distinct uint64.  Node pairs are ranges of both
    arrays that agree on ``depth`` leading bits; a step goes one bit down in all
    node pairs of a block.  Blocks wait on a stack, so memory stays bounded.
    """
    if not len(a) or not len(b):
        return
    stack = [(0, np.array([[0, len(a), 0, len(b), 0]], np.int64))]
    while stack:
        depth, nodes = stack.pop()
        if len(nodes) > at_once:
            half = len(nodes) // 2
            stack += [(depth, nodes[:half]), (depth, nodes[half:])]
            continue
        rows, cols = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        small = (rows * cols <= 32) | (depth == 64)
        if small.any():  # few leaves on both sides: compare them
            s, n = nodes[small], (rows * cols)[small]
            for at in range(0, len(s), at_once // 32):
                q, m = s[at:at + at_once // 32], n[at:at + at_once // 32]
                own = np.repeat(np.arange(len(q)), m)
                k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                w = (q[:, 3] - q[:, 2])[own]
                i, j = q[own, 0] + k // w, q[own, 2] + k % w
                near = np.bitwise_count(a[i] ^ b[j]) <= budget
                if near.any():
                    yield i[near], j[near]
            nodes = nodes[~small]
        if not len(nodes):
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        keep_bits = ~np.uint64(0) << np.uint64(63 - depth) if depth else bit
        mid_a = np.searchsorted(a, (a[nodes[:, 0]] & keep_bits) | bit)
        mid_b = np.searchsorted(b, (b[nodes[:, 2]] & keep_bits) | bit)
        mid_a = np.clip(mid_a, nodes[:, 0], nodes[:, 1])
        mid_b = np.clip(mid_b, nodes[:, 2], nodes[:, 3])
        err = nodes[:, 4]
        lo_a, hi_a, lo_b, hi_b = nodes[:, 0], nodes[:, 1], nodes[:, 2], nodes[:, 3]
        kids = np.concatenate([np.stack(x, 1) for x in (
            (lo_a, mid_a, lo_b, mid_b, err), (mid_a, hi_a, mid_b, hi_b, err),
            (lo_a, mid_a, mid_b, hi_b, err + 1), (mid_a, hi_a, lo_b, mid_b, err + 1))])
        kids = kids[(kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)]
        if len(kids):
            stack.append((depth + 1, kids))


class Forest:
    """Union of index pairs, vectorised; keeps the least index of each class."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.label[self.label], self.label):
                self.label = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        i = np.flatnonzero(self.label != np.arange(len(self.label)))
        return i, self.label[i]


def _join_leaf_pair(group: pd.DataFrame, budget: int) -> pd.DataFrame:
    fp = group["fp"].to_numpy().view(np.uint64)
    second = group["second"].to_numpy()
    # equal leaves: one side holds all rows, joined with itself
    a = np.sort(fp[~second])
    b = np.sort(fp[second]) if second.any() else (a if bool(group["same"].iloc[0]) else fp[:0])
    both = a if b is a else np.concatenate([a, b])
    forest, shift = Forest(len(both)), 0 if b is a else len(a)
    for i, j in trie_pairs(a, b, budget):
        forest.add(i, j + shift)
    u, v = forest.edges()
    return pd.DataFrame({"u": both[u].view(np.int64), "v": both[v].view(np.int64)})


def link_forest(fps: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """Spanning edges (u, v) of the links among the distinct fingerprints ``fp`` of ``fps`` (stored)."""
    spark = fps.sparkSession
    ship(spark)
    lead = F.shiftrightunsigned("fp", 64 - p.histogram_bits)
    counts = {r[0]: r[1] for r in fps.groupBy(lead.cast("int").alias("x")).count().collect()}  # at most 2 ** histogram_bits rows
    leaves = cut_leaves(counts, p)
    # leading bits -> leaf: the leaves in order are ranges of the histogram
    first = [x << (p.histogram_bits - d) for d, x in leaves]
    partners: dict[int, list[tuple[int, bool]]] = {i: [] for i in range(len(leaves))}
    for n, (i, j) in enumerate(leaf_pairs(leaves, p.max_bits)):
        partners[i].append((n, False))
        if i != j:
            partners[j].append((n, True))
    own = {n for i in partners for n, s in partners[i]} - {n for i in partners for n, s in partners[i] if s}
    rows = [(i, int(f), int(first[i + 1] if i + 1 < len(first) else 1 << p.histogram_bits), [(n, s, n in own) for n, s in partners[i]])
            for i, f in enumerate(first)]
    plan = spark.createDataFrame(rows, "leaf int, lo int, hi int, pairs array<struct<pair:int,second:boolean,same:boolean>>")
    leaf_of = spark.createDataFrame([(x, i) for i, lo, hi, _ in rows for x in range(lo, hi) if x in counts], "x int, leaf int")
    # both tables are bounded by the histogram and by max_leaves
    dealt = (fps.select("fp", lead.cast("int").alias("x")).join(F.broadcast(leaf_of), "x").join(F.broadcast(plan.select("leaf", "pairs")), "leaf")
             .select("fp", F.inline("pairs")))
    budget = p.max_bits
    return dealt.groupBy("pair").applyInPandas(lambda g: _join_leaf_pair(g, budget), "u long, v long")


def _grouped(rows: DataFrame, p: SimHashParams) -> DataFrame:
    """The stored rows (doc_id, fp and others), their component_id and root (of one component; several may have one component_id)."""
    by_fp = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(link_forest(by_fp, p))
    rooted = by_fp.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = staged(rooted.join(least, "root").select("fp", "component_id", "root"), "simhash-member")
    return rows.join(member, "fp")


def near_duplicates(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable) of each row."""
    rows = staged(fingerprints(docs, p.words), "simhash-fp")
    return _grouped(rows, p).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, p: SimHashParams = SimHashParams()) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id.

    Of rows that share this doc_id in the group the least fingerprint, then the
    least text hash, is kept; versions in other groups count there.  Rows of a
    kept doc_id and text are left once, the least by a hash of all columns.  Rows
    with a null doc_id stay (they cannot be named).
    """
    th = F.xxhash64("text")
    rows = staged(fingerprints(docs.select("doc_id", "text", th.alias("th")), p.words, ("th",)), "simhash-fp")
    kept = _grouped(rows, p).where("doc_id = component_id").groupBy("root").agg(F.min(F.struct("doc_id", "fp", "th")).alias("k"))
    kept = kept.select("k.doc_id", F.col("k.th").alias("__th"))
    named = docs.where("doc_id is not null").withColumn("__th", th).join(kept, ["doc_id", "__th"], "left_semi")
    order = Window.partitionBy("doc_id", "__th").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    named = named.withColumn("__rn", F.row_number().over(order)).where(F.col("__rn") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
    return named.union(docs.where("doc_id is null"))
