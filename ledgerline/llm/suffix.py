"""Exact removal of long repeated byte strings by suffix sorting (linear grouping).

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else; strings never cross documents.

1. Cut: the least gram hash in each ``length``-byte window is the window's anchor,
   so equal windows have equal anchors at equal offsets.  Windows with one anchor
   are a run of starts; a run is split at ``band`` bytes before the anchor, and
   named by a hash of the bytes around the anchor that all its windows hold.
   Only equal names can hold equal windows.  Names that occur once are done with.
2. Copies: runs with equal bytes (128-bit digest) are repeated as a whole, and
   stand once in what follows, however many there are.
   A name whose distinct runs hold more than ``bucket_bytes`` (a passage shorter
   than a window in many documents) is refined: its runs are cut into ranges of
   starts at fixed distances of the anchor, ``refine`` wide in turn, each named by
   the longer core that all its windows hold, and step 2 is done again.  A last
   width of 1 compares whole windows, so that nothing of such a name is left to sort.
3. Sort: the distinct runs of names that have several are dealt by name into
   buckets of about ``bucket_bytes``; no name brings more than that.  Their text is parsed into phrases that end where
   the following bytes say so (the same in every copy), and phrases are ranked in
   byte order together with the bytes that decided their end, so that the order
   of phrase sequences is the byte order of the suffixes.  ``suffix_order`` sorts
   them by linear grouping: groups of suffixes with one Lyndon prefix are
   processed in falling order, each extending the groups of its suffixes'
   previous smaller suffixes; then every suffix, in order, places the larger ones
   before it at the front of their groups.  Nothing is renamed or recursed into.
4. Windows: a start x bytes before a phrase is repeated if another start has the
   same x bytes there and a suffix with ``length - x`` bytes in common, which is a
   range of the sorted order.

Null text is empty.  Rows that repeat a doc_id and text are copies of each other
like any documents; a null doc_id is a document like others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, slices, small_broadcast, staged, texts

LAST = (1 << 63) - 1


@dataclass(frozen=True)
class SuffixParams:
    length: int = 400
    gram: int = 16                   # bytes of an anchor
    band: int = 200
    mean_phrase: int = 16            # a power of two
    max_phrase: int = 128
    bucket_bytes: int = 2 << 20
    refine: tuple[int, ...] = (25, 1)  # starts in a range of a refined run; ends in 1
    segment: int = 4 << 20           # bytes of a document that are cut at once
    broadcast_bytes: int = 24 << 20  # size check of the stored lists that are broadcast


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` (a power of two) bytes."""
    h, m, k = b.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while k < gram:
        h = h[:-k] * np.uint64(m) + h[k:] if len(h) > k else h[:0]
        m, k = m * m % 2 ** 64, 2 * k
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def runs(b: np.ndarray, p: SuffixParams) -> Iterator[tuple[int, int, int]]:
    """(first start, last start, anchor) of the windows of ``b`` by anchor, split at the band."""
    n = len(b) - p.length + 1
    if n <= 0:
        return
    w = p.length - p.gram + 1
    h = gram_hashes(b, p.gram)
    low = np.uint64((1 << 28) - 1)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # the first of equal hashes
    pad = np.full(-len(key) % w, ~np.uint64(0))
    rows = np.concatenate([key, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].reshape(-1)
    anchor = (np.minimum(behind[:n], ahead[w - 1:w - 1 + n]) & low).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(first[1:], n) - 1
    for s, e, a in zip(first.tolist(), last.tolist(), anchor[first].tolist()):
        mid = a - p.band  # starts up to here hold the band before the anchor
        if s <= mid:
            yield s, min(e, mid), a
        if e > mid:
            yield max(s, mid + 1), e, a


def _digest(kept: bytes, before: int) -> bytes:
    """Of a run's bytes; the anchor's offset is part of the run."""
    return hashlib.blake2b(kept, digest_size=16, salt=before.to_bytes(4, "little")).digest()


def _cut(text: bytes, p: SuffixParams) -> Iterator[tuple[int, int, int, bytes, int]]:
    """(name, first start, last start, digest of the bytes, anchor) of each run of a document."""
    for at in range(0, max(1, len(text) - p.length + 1), p.segment):
        part = text[at:at + p.segment + p.length - 1]
        for s, e, a in runs(np.frombuffer(part, np.uint8), p):
            core = part[a - p.band:a + p.gram] if s <= a - p.band else part[a:a + p.length - p.band]
            kept = part[s:e + p.length]
            yield xxhash.xxh64_intdigest(core, 1 + (s <= a - p.band)) - (1 << 63), at + s, at + e, _digest(kept, a - s), at + a


def _refined(kept: bytes, before: int, width: int, p: SuffixParams) -> Iterator[tuple[int, int, int, bytes]]:
    """(name, first start, last start, digest) of the ranges of a run's starts.

    ``kept`` has the anchor at ``before``; starts count in it.  Range k holds the starts k width to (k + 1) width - 1 bytes before the anchor.
    """
    n = len(kept) - p.length + 1
    for k in range((before - n + 1) // width, before // width + 1):
        s, e = max(0, before - (k + 1) * width + 1), min(n - 1, before - k * width)
        core = kept[before - k * width:before - (k + 1) * width + 1 + p.length]
        yield xxhash.xxh64_intdigest(core, 3 + k) - (1 << 63), s, e, _digest(kept[s:e + p.length], before - s)


# ---- suffix sorting -----------------------------------------------------------

def suffix_order(s: np.ndarray) -> list[int]:
    """Suffix array of integers whose last one is the least and unique."""
    n = len(s)
    by_symbol = np.argsort(s, kind="stable")
    first = np.concatenate([[True], s[by_symbol][1:] != s[by_symbol][:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    group_np, at_np = np.empty(n, np.int64), np.empty(n, np.int64)
    group_np[by_symbol], at_np[by_symbol] = start, np.arange(n)
    slot, group, at = by_symbol.tolist(), group_np.tolist(), at_np.tolist()  # slot -> suffix; a group is named by its first slot
    size = np.bincount(start, minlength=n).tolist()
    smaller = [-1] * n  # previous smaller suffix
    top = n - 1
    while top >= 0:
        g = group[slot[top]]
        members = slot[g:top + 1] if g == top else sorted(slot[g:top + 1])
        met: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        # those followed by more copies of this group's word come out higher
        for times in sorted(set(met.values()), reverse=True):
            moved = [j for j, c in met.items() if c == times]
            for j in moved:
                k = group[j]
                size[k] -= 1
                end, old = k + size[k], at[j]
                other = slot[end]
                slot[old], slot[end], at[other], at[j] = other, j, old, end
            new = [group[j] + size[group[j]] for j in moved]
            for j, k in zip(moved, new):
                group[j] = k
                size[k] += 1
        top = g - 1
    order, front, placed = [-1] * n, list(range(n)), [False] * n
    order[0], placed[n - 1] = n - 1, True
    front[group[n - 1]] += 1
    for i in range(n):
        j = order[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = smaller[j]
    return order


def phrase_begins(b: np.ndarray, lengths: np.ndarray, p: SuffixParams) -> np.ndarray:
    """Positions in the joined parts where a phrase begins; each depends on the bytes that follow, max_phrase + mean_phrase + 8 at most.

    Towards a part's end they also depend on what follows; no window's first phrase is there.
    """
    least = np.full(len(b) + p.mean_phrase, ~np.uint64(0))
    h = gram_hashes(b, 8)
    least[:len(h)] = h
    for k in 2 ** np.arange(int(np.log2(p.mean_phrase))):  # over the next mean_phrase positions
        least[:-k] = np.minimum(least[:-k], least[k:])
    mark = np.zeros(len(b), bool)
    mark[:len(h)] = h == least[:len(h)]
    ahead = np.concatenate([[0], np.cumsum(mark)])
    room = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(b))
    to = np.minimum(np.arange(len(b)) + p.max_phrase, len(b))
    return np.flatnonzero(mark | (ahead[to] == ahead[:-1]) & (room > p.max_phrase))  # long stretches without a mark: everywhere


def repeated_starts(parts: list[bytes], n_starts: list[int], p: SuffixParams) -> list[np.ndarray]:
    """For each part, which of its first ``n_starts`` positions start a window that occurs at another position."""
    context = p.max_phrase + p.mean_phrase + 8
    lengths = np.array([len(t) for t in parts])
    shift = np.concatenate([[0], np.cumsum(lengths)])
    joined = b"".join(parts)
    at = phrase_begins(np.frombuffer(joined, np.uint8), lengths, p)
    own = np.searchsorted(shift, at, "right") - 1
    end = shift[own + 1]
    follows = np.append(at[1:], len(joined))
    symbols = [joined[a:b] for a, b in zip(at.tolist(), np.minimum(follows + context, end).tolist())]
    rank = {x: k for k, x in enumerate(sorted(set(symbols)), len(parts))}
    value = np.array([rank[x] for x in symbols], np.int64)
    del symbols, rank
    # every part is closed by a value of its own, the last by the least
    closing = np.cumsum(np.bincount(own, minlength=len(parts)) + 1) - 1
    seq = np.empty(len(at) + len(parts), np.int64)
    inside = np.ones(len(seq), bool)
    inside[closing] = False
    seq[closing], seq[inside] = np.arange(len(parts))[::-1], value
    order = np.array(suffix_order(seq), np.int64)
    order = (np.cumsum(inside) - 1)[order[inside[order]]]  # phrases in suffix order

    flat = np.frombuffer(joined + b"\x00" * p.length, np.uint8)
    before = at - np.maximum(np.concatenate([[-1], at[:-1]]), shift[own] - 1)  # starts that this phrase is the first for
    at, own, end, before = at[order], own[order], end[order], before[order]
    pos = at - shift[own]
    common = np.zeros(len(at), np.int64)  # bytes in common with the suffix before it
    step = np.arange(p.length)
    for a in range(1, len(at), 4096):
        x, y = at[a:a + 4096], at[a - 1:a + 4095][:len(at[a:a + 4096])]
        differ = flat[x[:, None] + step] != flat[y[:, None] + step]
        equal = np.where(differ.any(1), differ.argmax(1), p.length)
        common[a:a + 4096] = np.minimum(equal, np.minimum(end[a:a + 4096] - x, end[a - 1:a + 4095][:len(x)] - y))
    starts = np.array(n_starts)[own]
    out = [np.zeros(n, bool) for n in n_starts]
    on = np.arange(len(at))  # phrases with a start x bytes before them
    left = np.zeros(len(at), np.uint64)
    for x in range(p.max_phrase + 1):
        keep = before[on] > x
        on, left = on[keep], left[keep]
        if x:
            left = (left ^ flat[at[on] - x].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            left ^= left >> np.uint64(32)
        takes = pos[on] - x < starts[on]
        if not takes.any():
            continue
        right = np.cumsum(common < p.length - x)[on[takes]]
        k = np.lexsort((left[takes], right))
        r, q = right[k], left[takes][k]
        same = (r[1:] == r[:-1]) & (q[1:] == q[:-1])
        again = np.zeros(len(k), bool)
        again[1:] |= same
        again[:-1] |= same
        hit = on[takes][k[again]]
        for i, s in zip(own[hit].tolist(), (pos[hit] - x).tolist()):
            out[i][s] = True
    return out


# ---- Spark --------------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("at"), F.xxhash64("text").alias("th"), "text")


def _spans(starts: np.ndarray) -> list[tuple[int, int]]:
    on = np.flatnonzero(np.diff(np.concatenate([[0], starts.astype(np.int8), [0]])))
    return list(zip(on[::2].tolist(), (on[1::2] - 1).tolist()))


def repeated_runs(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """(at, th, s, e): runs of starts of repeated windows, of each document (doc_id, text hash)."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=4 << 20):
            rows = [(k, *r) for k, t in enumerate(texts(b)) if len(t) >= p.length for r in _cut(t, p)]
            if rows:
                k, name, s, e, d, a = zip(*rows)
                k = pa.array(k)
                yield pa.RecordBatch.from_arrays([b.column("at").take(k), b.column("th").take(k), pa.array(name, pa.int64()), pa.array(s, pa.int64()), pa.array(e, pa.int64()),
                                                  pa.array(d, pa.binary()), pa.array(a, pa.int64())], ["at", "th", "name", "s", "e", "digest", "a"])

    keyed = _keyed(docs)
    def with_text(need: DataFrame) -> DataFrame:
        by_doc = need.groupBy("at", "th").agg(F.collect_list(F.struct("name", "copies", "s", "e", "a")).alias("need"))
        by_doc = small_broadcast(staged(by_doc, "suffix-by-doc"), p.broadcast_bytes)
        return keyed.select("at", "th", "text").join(by_doc, ["at", "th"])

    def finer(width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, limit=4 << 20):
                rows = []
                for at, th, t, need in zip(*(b.column(c).to_pylist() for c in ("at", "th", "text", "need"))):
                    t = t.encode()
                    rows += [(at, th, name, r["s"] + s, r["s"] + e, d, r["a"], r["copies"]) for r in need
                             for name, s, e, d in _refined(t[r["s"]:r["e"] + p.length], r["a"] - r["s"], width, p)]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 5 else pa.int64()) for k, c in enumerate(cols)], ["at", "th", "name", "s", "e", "digest", "a", "copies"])
        return run

    run_type = "at long, th long, name long, s long, e long, digest binary, a long"
    every = staged(keyed.select("at", "th", "text").mapInArrow(cut, run_type), "suffix-runs").withColumn("copies", F.lit(1).cast("long"))
    copied = calm = hot = None
    for width in (0, *p.refine):
        if width:
            every = staged(with_text(hot).mapInArrow(finer(width), run_type + ", copies long"), "suffix-finer")
        shared = staged(every.groupBy("name").count().where("count > 1").select("name"), "suffix-names")
        runs_ = staged(every.join(small_broadcast(shared, p.broadcast_bytes), "name", "left_semi"), "suffix-shared")
        one = staged(runs_.groupBy("name", "digest").agg(F.sum("copies").alias("copies"), F.min(F.struct("at", "th", "s", "e", "a")).alias("r")), "suffix-distinct")
        more = runs_.join(one.where("copies > 1").select("name", "digest"), ["name", "digest"], "left_semi").select("at", "th", "s", "e")
        copied = more if copied is None else copied.union(more)
        if width == 1:  # equal windows have equal digests
            break
        held = F.sum(F.col("r.e") - F.col("r.s") + p.length)
        several = staged(one.groupBy("name").agg(F.count("*").alias("n"), held.alias("held")).where("n > 1").select("name", "held"), "suffix-several")
        need = staged(one.join(small_broadcast(several, p.broadcast_bytes), "name").select("name", "held", "copies", "r.*"), "suffix-need")
        fits = need.where(F.col("held") <= p.bucket_bytes)
        calm = fits if calm is None else calm.union(fits)
        hot = need.where(F.col("held") > p.bucket_bytes)
        if hot.isEmpty():
            break
    total = calm.agg(F.sum(F.col("e") - F.col("s") + p.length)).first()[0] or 0
    buckets = max(1, -(-int(total) // p.bucket_bytes))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=4 << 20):
            rows = []
            for at, th, t, need in zip(*(b.column(c).to_pylist() for c in ("at", "th", "text", "need"))):
                t = t.encode()
                rows += [(at, th, r["name"], r["copies"], r["s"], t[r["s"]:r["e"] + p.length]) for r in need]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in list(zip(*rows))[:5]), pa.array([r[5] for r in rows], pa.binary())], ["at", "th", "name", "copies", "s", "bytes"])

    parts = with_text(calm).mapInArrow(fetch, "at long, th long, name long, copies long, s long, bytes binary")

    def sort_bucket(g: pd.DataFrame) -> pd.DataFrame:
        g = g.drop_duplicates(["at", "th", "name", "s"])  # rows that repeat a doc_id and text
        parts = g["bytes"].tolist()
        found = repeated_starts(parts, [len(t) - p.length + 1 for t in parts], p)
        rows = [(a, t, s + x, s + y) for a, t, s, c, f in zip(g["at"], g["th"], g["s"], g["copies"], found) if c == 1 for x, y in _spans(f)]
        return pd.DataFrame(rows, columns=["at", "th", "s", "e"]).astype("int64")

    dealt = parts.withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)))
    sorted_ = dealt.groupBy("bucket").applyInPandas(sort_bucket, "at long, th long, s long, e long")
    return copied.union(sorted_)


def remove_repeats(docs: DataFrame, p: SuffixParams = SuffixParams(), keep_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row (and ``kept``, the bytes that are left)."""
    ship(docs.sparkSession)
    found = staged(repeated_runs(docs, p).distinct().groupBy("at", "th").agg(F.collect_list(F.struct("s", "e")).alias("runs")), "suffix-found")
    rows = _keyed(docs).join(small_broadcast(found, p.broadcast_bytes), ["at", "th"], "left").select("doc_id", "text", "runs")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for t, spans in zip(texts(b), b.column("runs").to_pylist()):
                merged: list[list[int]] = []
                for s, e in sorted((r["s"], r["e"] + p.length) for r in spans or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                edges = [0, *(x for m in merged for x in m), len(t)]
                kept = b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((len(t), len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), *([pa.array(cols[4], pa.binary())] if keep_bytes else [])], schema.names)

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
                           T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if keep_bytes else [])])
    return rows.mapInArrow(remove, schema)
