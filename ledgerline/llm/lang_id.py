"""Language identification by prediction by partial matching (PPM).

Each language has a variable-order tree of byte contexts (up to three bytes)
with symbol counts, frozen after training.  A symbol costs
``-log2(c / (n + d))`` in the longest known context that has seen it, where
``n`` counts the context's symbols and ``d`` the distinct ones; each context
left on the way costs its escape, ``-log2(d / (n + d))``, and below order 0
stands a uniform byte.  The language with the shortest code for the whole
text wins.

Frozen statistics make the cost of a byte a function of its context node and
its value, so the trees of all languages are laid out as one table
``[node, byte] -> bits per language``.  Text is scored by array lookups with no
state between rows; any partitioning gives the same result.

Training reads a bounded sample (``docs_per_lang`` whole documents of each of
the ``max_langs`` most frequent languages, by a hash of doc_id).  The n-gram
counts are made and summed in Spark.

Null text, or text with no letter: ``und`` with score 0.  With nothing to
learn from every document is ``und``.  A null doc_id is never held out and
never learned from.  Repeated rows and ties: each row gets its own result;
equal code lengths go to the first language in name order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import crc_mod, ship, slices, texts

ORDER = 3
SEP = b"\x00" * ORDER
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class PpmParams:
    docs_per_lang: int = 600
    max_langs: int = 64
    min_context: int = 8          # occurrences that a context needs to be a node
    max_nodes: int = 16_000
    table_bytes: int = 96 << 20   # bound of the cost table


@dataclass
class PpmModel:
    langs: list[str]
    symbol: np.ndarray            # byte -> symbol, 0: not in the training text
    node: np.ndarray              # three symbols -> node of the longest known context
    bits: np.ndarray              # node * symbols + symbol -> cost per language
    n_symbols: int


def training_sample(docs: DataFrame, p: PpmParams) -> DataFrame:
    """(lang, text) of at most ``docs_per_lang`` whole documents a language."""
    ids = docs.select("doc_id", "lang").where(F.col("lang").isNotNull() & (crc_mod("doc_id", 4) != 2))
    top = [r["lang"] for r in ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(p.max_langs).collect()]
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = (ids.where(F.col("lang").isin(top)).withColumn("rn", F.row_number().over(w))
              .where(F.col("rn") <= p.docs_per_lang).select("doc_id", "lang").distinct())
    # at most docs_per_lang * max_langs ids
    return docs.select("doc_id", "lang", "text").join(F.broadcast(picked), ["doc_id", "lang"], "left_semi")


def _count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        by_lang: dict[str, list[bytes]] = {}
        for lang, t in zip(b.column("lang").to_pylist(), texts(b)):
            by_lang.setdefault(lang, []).append(t)
        for lang, ts in by_lang.items():
            flat = np.frombuffer(SEP + SEP.join(ts), np.uint8).astype(np.int64)
            key = np.zeros(len(flat), np.int64)
            for k in range(ORDER + 1):  # key: the k context bytes and the symbol
                key = key + (np.concatenate([np.zeros(k, np.int64), flat[: len(flat) - k]]) << (8 * k))
                whole = np.ones(len(flat), bool)
                for j in range(k + 1):
                    whole[j:] &= flat[: len(flat) - j] > 0
                    whole[:j] = False
                grams, n = np.unique(key[whole], return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(grams), pa.string()), "k": pa.array(np.full(len(grams), k, np.int32)),
                                                  "gram": pa.array(grams), "n": pa.array(n.astype(np.int64))})


def train(docs: DataFrame, params: PpmParams = PpmParams()) -> PpmModel | None:
    """Fit on the learnable rows of ``docs``; None if there are none."""
    ship(docs.sparkSession)
    counts = (training_sample(docs, params).mapInArrow(_count_ngrams, "lang string, k int, gram long, n long")
              .groupBy("lang", "k", "gram").agg(F.sum("n").alias("n")).toPandas())
    return _build(counts, params) if len(counts) else None


def _build(counts, p: PpmParams) -> PpmModel:
    langs = sorted(counts["lang"].unique())
    lang_of = counts["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy()
    k, gram, n = (counts[c].to_numpy() for c in ("k", "gram", "n"))
    alphabet = np.unique(gram[k == 0])
    symbol = np.zeros(256, np.int64)
    symbol[alphabet] = np.arange(1, len(alphabet) + 1)
    a1, nl = len(alphabet) + 1, len(langs)

    # nodes: the empty context, and the most frequent longer ones; a suffix of
    # a context is at least as frequent, so a node's parent is a node as well
    room = max(1, min(p.max_nodes, p.table_bytes // (a1 * nl * 4)) - 1)
    ctx = np.concatenate([(gram[k == j] >> 8) + (np.int64(j) << 32) for j in range(1, ORDER + 1)])
    uniq, inv = np.unique(ctx, return_inverse=True)
    total = np.bincount(inv, np.concatenate([n[k == j] for j in range(1, ORDER + 1)]), len(uniq)) if len(uniq) else np.zeros(0)
    length = uniq >> 32
    best = np.lexsort((uniq, length, -total))[:room]
    chosen = uniq[np.sort(best[total[best] >= p.min_context])]
    chosen = chosen[np.argsort(chosen, kind="stable")]  # short contexts first
    node_of = {0: 0} | {int(c): i + 1 for i, c in enumerate(chosen)}
    bits = np.full((len(node_of) * a1, nl), 8.0)

    codes = np.array([0, *chosen], np.int64)
    by_len = {j: codes[(codes >> 32) == j] for j in range(ORDER + 1)}
    for j in range(ORDER + 1):
        rows = k == j
        c_code = (gram[rows] >> 8) + (np.int64(j) << 32)
        at = np.searchsorted(codes, c_code)
        known = (at < len(codes)) & (codes[np.minimum(at, len(codes) - 1)] == c_code)
        c_node, c_sym, c_lang, c_n = at[known], symbol[gram[rows][known] & 255], lang_of[rows][known], n[rows][known]
        nodes = np.flatnonzero((codes >> 32) == j)
        local = np.full(len(codes), -1, np.int64)
        local[nodes] = np.arange(len(nodes))
        seen = np.zeros((len(nodes), a1, nl))
        seen[local[c_node], c_sym, c_lang] = c_n
        total_n, distinct = seen.sum(1), (seen > 0).sum(1)
        if j:  # parent: the context without its oldest byte
            up = np.array([node_of[int((codes[x] & 0xFFFFFFFF & ((1 << (8 * (j - 1))) - 1)) + ((j - 1) << 32)) if j > 1 else 0] for x in nodes], np.int64)
            below = bits.reshape(-1, a1, nl)[up]
        else:
            below = np.full((len(nodes), a1, nl), 8.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total_n > 0, -np.log2(distinct / (total_n + distinct)), 0.0)
            hit = -np.log2(seen / (total_n + distinct)[:, None, :])
        bits.reshape(-1, a1, nl)[nodes] = np.where(seen > 0, hit, escape[:, None, :] + below)

    # (symbol three back, two back, one back) -> node; an unknown symbol ends the context
    byte_of = np.concatenate([[0], alphabet]).astype(np.int64)
    known1 = np.array([node_of.get(int(byte_of[s]) + (1 << 32), 0) if s else 0 for s in range(a1)], np.int32)
    node = np.broadcast_to(known1, (a1, a1, a1)).copy()
    back = symbol
    for code in by_len[2]:
        node[:, back[(code >> 8) & 255], back[code & 255]] = node_of[int(code)]
    for code in by_len[3]:
        node[back[(code >> 16) & 255], back[(code >> 8) & 255], back[code & 255]] = node_of[int(code)]
    return PpmModel(langs, symbol.astype(np.int32), node.reshape(-1), bits.astype(np.float32), a1)


def code_lengths(model: PpmModel, docs: list[bytes], chunk: int = 1 << 19) -> np.ndarray:
    """Bits of each whole document under each language, shape (docs, languages)."""
    out = np.zeros((len(docs), len(model.langs)))
    ends = np.cumsum([len(d) + ORDER for d in docs])
    starts = ends - np.array([len(d) for d in docs], np.int64)
    flat = np.frombuffer(SEP + SEP.join(docs), np.uint8)
    a1 = np.int32(model.n_symbols)
    for lo in range(ORDER, len(flat), chunk):
        hi = min(len(flat), lo + chunk)
        s = model.symbol[flat[lo - ORDER:hi]]
        ctx = (s[:-3] * a1 + s[1:-2]) * a1 + s[2:-1]
        cost = model.bits[model.node[ctx].astype(np.int64) * a1 + s[3:]]
        first, last = np.searchsorted(ends, lo, "right"), np.searchsorted(starts, hi, "left")
        cut = np.stack([np.maximum(starts[first:last], lo), np.minimum(ends[first:last], hi)], 1) - lo
        which = np.arange(first, last)[cut[:, 1] > cut[:, 0]]
        cut = cut[cut[:, 1] > cut[:, 0]]
        if len(which):
            # pairs (start, end); the sums over what lies between documents are dropped,
            # and an end at the chunk's own end is implied
            edges = cut.reshape(-1) if cut[-1, 1] < len(cost) else cut.reshape(-1)[:-1]
            out[which] += np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[::2]
    return out


def _verdicts(model: PpmModel | None, docs: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, its posterior, and bits per byte of its code."""
    lettered = np.array([bool(LETTER.search(d.decode("utf8", "replace"))) for d in docs], bool)
    if model is None or not len(docs):
        return ["und"] * len(docs), np.zeros(len(docs)), np.full(len(docs), 8.0)
    cost = code_lengths(model, docs)
    best = cost.argmin(1)
    least = cost[np.arange(len(docs)), best]
    score = 1.0 / np.exp2(least[:, None] - cost).sum(1)
    size = np.maximum(1, [len(d) for d in docs])
    return ([model.langs[i] if ok else "und" for i, ok in zip(best, lettered)],
            np.where(lettered, score, 0.0), np.where(lettered, least / size, 8.0))


def identify(docs: DataFrame, model: PpmModel | None) -> DataFrame:
    """doc_id, lang_pred, score, bits_per_byte of each row; only ``text`` is read for it."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by table_bytes

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, p, bits = _verdicts(shared.value, texts(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(p), pa.array(bits)],
                                             ["doc_id", "lang_pred", "score", "bits_per_byte"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(score, schema)


def keep_identified(docs: DataFrame, model: PpmModel | None, max_bits: float = 8.0) -> DataFrame:
    """The rows in a learned language: not ``und``, and compressed below ``max_bits`` a byte.

    At 8 bits the best model explains the text no better than raw bytes do
    (random strings, another script); prose in a learned language costs 2 to 4.
    Columns are unchanged.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, _, bits = _verdicts(shared.value, texts(b))
            yield b.filter(pa.array([x != "und" and y < max_bits for x, y in zip(lang, bits)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
