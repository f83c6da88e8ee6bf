"""Target-distribution importance resampling by bit-sliced aggregation.

A document's features (runs of one to three consecutive words, hashed to
``buckets``) are counted per bucket, and the counts are sliced into bit planes:
bit b of plane k is binary digit k of bucket b's count.  The gain of a bucket, an
integer log ratio of the target's and the corpus's rates, is sliced likewise, its
top plane counting negatively (two's complement).  The weight, the sum of gains
over the features, is then exact without a multiplication:

    weight = sum over planes k, j of +-2^(k + j) * popcount(document plane k AND gain plane j)

Corpus counts are taken over all documents first (one partial sum of ``buckets``
numbers a task); the texts are read again for the weights, so that nothing as
large as the planes is stored.  The draw adds a Gumbel variate, fixed by a hash of
the doc_id, and takes the highest scores (sampling without replacement with
probability proportional to exp(weight / scale)).  Its ranks come from a cut on a
bounded histogram of the scores, a range partition of what lies above, and running
counts; no task sees all rows.

Null or empty text has no feature: weight 0.  Rows that repeat a doc_id are rows
of their own; equal scores rank by doc_id, then weight, then number of features.  A
null doc_id has no variate: score and rank null, and it isn't among the N.
An empty target or corpus counts nothing, and smoothing alone sets the gains.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, slices, staged, texts

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # after lower-casing A-Z: ASCII letters and digits, all that isn't ASCII
NOT_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")


@dataclass(frozen=True)
class ImportanceParams:
    buckets: int = 10_000
    scale: int = 1_000        # gains and variates are floors of this many times their logarithms
    min_words: int = 20
    percent: int = 5
    seed: int = 42
    rank_rows: int = 200_000  # drawn rows numbered by one task


# ---- features -----------------------------------------------------------------

def _crc_tables() -> np.ndarray:
    """CRC register after 2^k more zero bytes, as lookups by byte of the register: [k, byte, value]."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    step = lambda x: one[x & 255] ^ (x >> np.uint32(8))
    tables = [np.stack([step(np.arange(256, dtype=np.uint32) << np.uint32(8 * j)) for j in range(4)])]
    for _ in range(31):
        tables.append(_through(tables[-1], tables[-1]))
    return np.stack(tables)


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return (table[0][x & 255] ^ table[1][(x >> np.uint32(8)) & 255] ^ table[2][(x >> np.uint32(16)) & 255] ^ table[3][x >> np.uint32(24)])


CRC = _crc_tables()


def joined_crc(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of the concatenation of strings with checksums ``a`` and ``b``, the second ``size`` bytes long."""
    a = a.copy()
    for k in range(int(size.max()).bit_length() if len(size) else 0):
        on = (size >> k) & 1 == 1
        a[on] = _through(CRC[k], a[on])
    return a ^ b


def _pieces(text: bytes, limit: int = 1 << 20) -> Iterator[bytes]:
    """The text cut between words into pieces of about ``limit`` bytes."""
    at = 0
    while len(text) - at > limit:
        end = NOT_WORD.search(text, at + limit)
        if end is None:
            break
        yield text[at:end.start()]
        at = end.start()
    yield text[at:] if at else text


def word_blocks(docs: list[bytes], at_once: int = 1 << 17) -> Iterator[tuple[np.ndarray, list[bytes], int]]:
    """(document of each word, words, how many of them the block before ended with) in order."""
    doc, words, old = [], [], 0
    for n, text in enumerate(docs):
        for piece in _pieces(text.lower()):
            found = WORD.findall(piece)
            words += found
            doc.append(np.full(len(found), n, np.int64))
            if len(words) >= at_once:
                doc = [np.concatenate(doc)]
                yield doc[0], words, old
                doc, words, old = [doc[0][-2:]], words[-2:], 2
    yield (np.concatenate(doc) if doc else np.zeros(0, np.int64)), words, old


def bucket_counts(docs: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, count) of every bucket a document hits, sorted, and the words of each document."""
    keys, counts, n_words = [], [], np.zeros(len(docs), np.int64)
    for doc, words, old in word_blocks(docs):
        index: dict[bytes, int] = {}
        ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
        crc = np.array([zlib.crc32(w) for w in index], np.uint32)
        spaced = np.array([zlib.crc32(b" " + w) for w in index], np.uint32)
        size = np.array([len(w) + 1 for w in index], np.int64)
        run = crc[ids] if len(ids) else np.zeros(0, np.uint32)
        n_words += np.bincount(doc[old:], minlength=len(docs))
        found = [(doc[old:], run[old:])]
        for n in (2, 3):
            if len(ids) < n:
                break
            # a run of n words that ends here: the run of n - 1 that ended one word before, a space, this word
            run = joined_crc(run[:-1], spaced[ids[n - 1:]], size[ids[n - 1:]])
            ok = (doc[n - 1:] == doc[: 1 - n]) & (np.arange(n - 1, len(ids)) >= old)
            found.append((doc[n - 1:][ok], run[ok]))
        key = np.concatenate([d * buckets + (r % np.uint32(buckets)).astype(np.int64) for d, r in found])
        k, c = np.unique(key, return_counts=True)
        keys.append(k)
        counts.append(c)
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key // buckets, key % buckets, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64), n_words


def bucket_totals(rows: DataFrame, p: ImportanceParams) -> np.ndarray:
    """Features of each bucket over all texts of a table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.buckets, np.int64)
        for b in slices(batches, limit=4 << 20):
            _, bucket, n, _ = bucket_counts(texts(b), p.buckets)
            total += np.bincount(bucket, n, p.buckets).astype(np.int64)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    ship(rows.sparkSession)
    sums = rows.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row a bucket
    out = np.zeros(p.buckets, np.int64)
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out


# ---- bit planes -----------------------------------------------------------------

def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    raw = np.packbits(bits, axis=-1, bitorder="little")
    pad = -raw.shape[-1] % 8
    return np.ascontiguousarray(np.pad(raw, [(0, 0)] * (raw.ndim - 1) + [(0, pad)])).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes, value of each) of signed integers: powers of two, the top one negative."""
    width = max(int(gain.max(initial=0)).bit_length(), int(-gain.min(initial=0) - 1).bit_length() if gain.min(initial=0) < 0 else 0)
    value = np.array([1 << j for j in range(width)] + [-(1 << width)], np.int64)
    return packed(((gain[None, :] >> np.arange(width + 1)[:, None]) & 1).astype(bool)), value


def weights(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, n_docs: int, planes: np.ndarray, value: np.ndarray,
            buckets: int, at_once: int = 128) -> np.ndarray:
    """Sum of the gains over the features of each document, from bit planes alone."""
    out = np.zeros(n_docs, np.int64)
    edges = np.searchsorted(doc, np.arange(0, n_docs + at_once, at_once))
    for g, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        row, b, n = doc[lo:hi] - g * at_once, bucket[lo:hi], count[lo:hi]
        k = 0
        while len(n):
            on = n & 1 == 1
            hit, row_at = np.unique(row[on], return_inverse=True)
            if len(hit):
                bits = np.zeros((len(hit), buckets), bool)
                bits[row_at, b[on]] = True
                document = packed(bits)
                for plane, v in zip(planes, value):
                    out[hit + g * at_once] += (np.bitwise_count(document & plane).sum(1, dtype=np.int64) * v) << k
            row, b, n = row[n > 1], b[n > 1], n[n > 1] >> 1
            k += 1
    return out


def gains(corpus: np.ndarray, target: np.ndarray, p: ImportanceParams) -> np.ndarray:
    """floor(scale * ln of the smoothed rate in the target over that in the corpus) of each bucket."""
    s, t = corpus.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + p.buckets)) / ((s + 1) * (t.sum() + p.buckets))
    return np.floor(p.scale * np.log(ratio)).astype(np.int64)


# ---- the operator -----------------------------------------------------------------

def weigh(docs: DataFrame, target: DataFrame, p: ImportanceParams = ImportanceParams()) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row of ``docs``, in favour of the texts of ``target``."""
    spark = docs.sparkSession
    planes, value = gain_planes(gains(bucket_totals(docs, p), bucket_totals(target, p), p))
    shared = spark.sparkContext.broadcast(planes)  # bounded: some twenty planes of one bit a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=4 << 20):
            doc, bucket, n, n_words = bucket_counts(texts(b), p.buckets)
            weight = weights(doc, bucket, n, b.num_rows, shared.value, value, p.buckets)
            features = np.bincount(doc, n, b.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_words), pa.array(features), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def gumbel(doc_id: Column, p: ImportanceParams) -> Column:
    """floor(scale * a Gumbel variate) fixed by a hash of the id; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{p.seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(p.scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _bin(score: Column) -> Column:
    """A monotone bin of a whole number; some thousand bins whatever the scores are."""
    return (F.signum(score) * F.floor(F.log2(F.abs(score) + F.lit(1.0)) * 64)).cast("int")


def resample(docs: DataFrame, target: DataFrame, p: ImportanceParams = ImportanceParams()) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of each row of ``docs``; rank null unless drawn."""
    spark = docs.sparkSession
    weighed = weigh(docs, target, p)
    scored = staged(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), p)).withColumn("bin", _bin(F.col("score"))), "resample-scores")
    may = (F.col("n_words") >= p.min_words) & F.col("score").isNotNull()
    bins = sorted(scored.where(may).groupBy("bin").count().collect(), key=lambda r: -r["bin"])  # bounded: some thousand bins
    wanted = sum(r["count"] for r in bins) * p.percent // 100
    above, cut = 0, None
    for r in bins:
        if above >= wanted:
            break
        above, cut = above + r["count"], r["bin"]
    names = ("doc_id", "n_words", "n_features", "weight", "score")
    if cut is None:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    near = F.coalesce(may & (F.col("bin") >= cut), F.lit(False))
    order = [F.desc("score"), F.asc("doc_id"), F.desc("weight"), F.desc("n_features"), F.asc("row")]
    top = scored.where(near).withColumn("row", F.monotonically_increasing_id())
    dealt = staged(top.repartitionByRange(-(-above // p.rank_rows), *order).select(*names, "row", F.spark_partition_id().alias("part")), "resample-top")
    before, total = {}, 0
    for r in sorted(dealt.groupBy("part").count().collect(), key=lambda r: r["part"]):  # a row for each ``rank_rows`` drawn rows
        before[r["part"]], total = total, total + r["count"]
    starts = spark.createDataFrame(list(before.items()), "part int, start long")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("start")
    ranked = dealt.join(F.broadcast(starts), "part").select(*names, place.cast("long").alias("rank"))
    return (ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
            .unionByName(scored.where(~near).select(*names, F.lit(None).cast("long").alias("rank"))))
