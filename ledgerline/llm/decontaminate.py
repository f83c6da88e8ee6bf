"""Benchmark decontamination by spaced-seed hashing.

Words are ``\\w+`` of the lower-cased text.  A seed is a fixed mask over a few
word positions; its hash leaves the positions marked 0 out, so that a changed
word there still hits.  The two masks of the defaults hit every stretch of eight
or more words of which 80 % agree: k changed words leave k + 1 runs, one of them
of four words if k >= 4, and the tests go through all placements up to 25 words.

Each hit puts document and item on a diagonal.  All words of both on that
diagonal are compared (diagonals with too few equal words in all are passed
over), and the longest stretch in which at least ``equal`` of the words agree
counts if it has ``min_words`` words (or the whole of a shorter item).  Insertions shift the diagonal; the parts on either side count by
themselves.

The benchmark's seeds are broadcast in blocks of items that hold about
``block_words`` words; each block runs over all documents, so neither the driver
nor a task holds more of a larger benchmark.

Items of fewer than ``min_item_words`` words are too short for a changed word: they
match where all their words stand in a row, found by a hash of the whole item.
Items without a word (also null text) match nothing, nor do null documents.
Repeated rows give repeated results; equal stretches of an item: the first counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, slices

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class SeedParams:
    masks: tuple[str, ...] = ("1111", "11011")  # sized for equal and min_item_words
    min_words: int = 13
    equal: float = 0.8
    min_item_words: int = 8
    block_words: int = 2_000_000
    hits_at_once: int = 1 << 17   # seed hits of a document that are looked at together


@dataclass
class SeedIndex:
    vocab: dict[str, int]
    item_ids: list
    items: list[np.ndarray]       # word ids
    flat: np.ndarray              # the same, joined, and where each item begins
    begin: np.ndarray
    hashes: list[np.ndarray]      # of each mask, sorted
    item: list[np.ndarray]        # item and position of each hash
    pos: list[np.ndarray]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # words of an item -> hashes of such items, sorted, and the items


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _seed_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    n = len(ids) - len(mask) + 1
    h = np.zeros(max(n, 0), np.uint64)
    for at, used in enumerate(mask):
        if used == "1" and n > 0:
            h = (h ^ ids[at:at + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return h


def build_index(rows: list[tuple], p: SeedParams) -> SeedIndex:
    vocab: dict[str, int] = {}
    kept = [(i, w) for i, t in rows if (w := words(t or ""))]
    items = [np.array([vocab.setdefault(x, len(vocab)) for x in w], np.int64) for _, w in kept]
    flat = np.concatenate(items) if items else np.zeros(0, np.int64)
    index = SeedIndex(vocab, [i for i, _ in kept], items, flat, np.cumsum([0, *map(len, items)]), [], [], [], {})
    for n in sorted({len(x) for x in items if len(x) < p.min_item_words}):
        which = np.array([k for k, x in enumerate(items) if len(x) == n])
        h = np.concatenate([_seed_hashes(items[k], "1" * n) for k in which])
        order = np.argsort(h, kind="stable")
        index.short[n] = h[order], which[order]
    for mask in p.masks:
        per = [_seed_hashes(x if len(x) >= p.min_item_words else x[:0], mask) for x in items]
        h = np.concatenate(per) if per else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        index.hashes.append(h[order])
        index.item.append(np.repeat(np.arange(len(per)), [len(x) for x in per])[order])
        index.pos.append((np.concatenate([np.arange(len(x)) for x in per]) if per else np.zeros(0, np.int64))[order])
    return index


def longest_stretch(same: np.ndarray, equal: float) -> tuple[int, int]:
    """Start and end of the longest stretch with at least ``equal`` of true values; it begins and ends in true ones."""
    score = np.concatenate([[0.0], np.cumsum(np.where(same, 1 - equal, -equal))])
    low = np.minimum.accumulate(score)
    best = (0, 0)
    for end in range(len(same), 0, -1):
        if end < best[1] - best[0] or not same[end - 1]:
            continue
        # the first prefix that is not above: low falls, so its first index is found by bisection
        start = int(np.searchsorted(-low[:end], -(score[end] + 1e-9), "left"))
        while start < end and not same[start]:
            start += 1
        if end - start > best[1] - best[0] or end - start == best[1] - best[0] and start < best[0]:
            best = (start, end)
    return best


def _hits(ids: np.ndarray, index: SeedIndex, p: SeedParams) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item, shift) of the seed hits, some ``hits_at_once`` together, distinct in each."""
    known = np.concatenate([[0], np.cumsum(ids >= 0)])
    span = len(ids) + 1 + int(np.diff(index.begin).max(initial=0))
    for mask, hashes, item, pos in zip(p.masks, index.hashes, index.item, index.pos):
        n = len(ids) - len(mask) + 1
        if n <= 0 or not len(hashes):
            continue
        at = np.flatnonzero(known[len(mask):] - known[:n] >= mask.count("1"))  # else a used word is unknown
        if not len(at):
            continue
        h = _seed_hashes(ids, mask)[at]
        lo = np.searchsorted(hashes, h, "left")
        on = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == h)
        at, lo = at[on], lo[on]
        ends = np.cumsum(np.searchsorted(hashes, h[on], "right") - lo)  # of each position's hits
        for first in range(0, int(ends[-1]) if len(ends) else 0, p.hits_at_once):
            k = np.arange(first, min(first + p.hits_at_once, int(ends[-1])))
            own = np.searchsorted(ends, k, "right")
            k = lo[own] + k - np.where(own > 0, ends[own - 1], 0)
            key = np.unique(item[k] * (2 * span) + (at[own] - pos[k] + span))
            yield key // (2 * span), key % (2 * span) - span


def _whole_items(ids: np.ndarray, index: SeedIndex) -> Iterator[tuple[int, int]]:
    """(item, first place in the document) of the short items whose words all stand in a row there."""
    for n, (hashes, item) in index.short.items():
        h = _seed_hashes(ids, "1" * n)
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        found: dict[int, int] = {}
        for at in np.flatnonzero(hi > lo).tolist():
            for i in item[lo[at]:hi[at]].tolist():
                if i not in found and np.array_equal(index.items[i], ids[at:at + n]):
                    found[i] = at
        yield from found.items()


def overlaps(text: str, index: SeedIndex, p: SeedParams) -> list[tuple[int, int, int, int, int]]:
    """(item, start in the document, start in the item, words, equal words): the longest of each item."""
    get = index.vocab.get
    ids = np.array([get(w, -1) for w in words(text)], np.int64)
    best: dict[int, tuple[int, int, int, int, int]] = {
        i: (at, 0, len(index.items[i]), len(index.items[i]), at) for i, at in _whole_items(ids, index)}
    for item, shift in _hits(ids, index, p):
        length = index.begin[item + 1] - index.begin[item]
        lo, hi = np.maximum(0, -shift), np.minimum(length, len(ids) - shift)
        wanted = np.minimum(p.min_words, length)
        few = max(1, p.hits_at_once * 4 // int((hi - lo).max()))  # diagonals whose words are compared at once
        for x in range(0, len(item), few):
            i, s, a, n = item[x:x + few], shift[x:x + few], lo[x:x + few], (hi - lo)[x:x + few]
            ends = np.cumsum(n)
            step = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(a, n)
            same = ids[step + np.repeat(s, n)] == index.flat[step + np.repeat(index.begin[i], n)]
            total = np.add.reduceat(same.astype(np.int64), ends - n)
            for k in np.flatnonzero(total >= p.equal * wanted[x:x + few] - 1e-9).tolist():
                on = same[ends[k] - n[k]:ends[k]]
                b, c = longest_stretch(on, p.equal)
                if c - b < wanted[x + k]:
                    continue
                at, old = int(s[k]), best.get(int(i[k]))
                if old is None or (old[2], -old[4]) < (c - b, -at):  # of equal ones that of the least shift
                    best[int(i[k])] = (int(a[k] + s[k] + b), int(a[k] + b), c - b, int(on[b:c].sum()), at)
    return [(i, *x[:4]) for i, x in sorted(best.items())]


def _blocks(benchmark: DataFrame, p: SeedParams) -> Iterator[SeedIndex]:
    """Indexes of bounded size that hold all items."""
    n_words = benchmark.agg(F.sum(F.size(F.split("text", r"\W+")))).first()[0] or 0
    n = max(1, -(-int(n_words) // p.block_words))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = [(r["item_id"], r["text"]) for r in benchmark.where(block == k).select("item_id", "text").collect()]
        yield build_index(rows, p)


def find_leaks(docs: DataFrame, benchmark: DataFrame, p: SeedParams = SeedParams()) -> DataFrame:
    """doc_id, item_id, doc_start, item_start, n_words, n_equal of every verified overlap (the longest of each pair)."""
    spark = docs.sparkSession
    ship(spark)
    id_type = benchmark.schema["item_id"].dataType
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("item_id", id_type),
                           *[T.StructField(c, T.LongType()) for c in ("doc_start", "item_start", "n_words", "n_equal")]])
    out = None
    for index in _blocks(benchmark, p):
        shared = spark.sparkContext.broadcast(index)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                ids, found = b.column("doc_id"), []
                for k, t in enumerate(b.column("text").to_pylist()):
                    found += [(k, *x) for x in overlaps(t, shared.value, p)] if t else []
                if found:
                    row, item, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array([shared.value.item_ids[i] for i in item], ids.type),
                                                      *[pa.array(x, pa.int64()) for x in rest]], schema.names)

        part = docs.select("doc_id", "text").mapInArrow(find, schema)
        out = part if out is None else out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, p: SeedParams = SeedParams()) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item; columns as given."""
    spark = docs.sparkSession
    ship(spark)
    for index in _blocks(benchmark, p):
        shared = spark.sparkContext.broadcast(index)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                yield b.filter(pa.array([not (t and overlaps(t, shared.value, p)) for t in b.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
