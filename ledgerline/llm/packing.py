"""Best-fit packing of documents into sequences of several permitted lengths.

A document's length is its UTF-8 bytes plus one end mark (a byte-level model's
tokens); a longer document than the largest sequence is cut into pieces.
Pieces are dealt to shards of about ``shard_rows``; each shard is packed by
itself, so the work grows by shards and none holds the corpus.

In a shard the pieces go in by falling length, each into the open bin with the
least room that fits.  If none fits, every permitted length that holds the piece is
weighed: it is filled, on paper, with the largest of the pieces still to come that
fit, downsized to what it then holds, and the length of least cost a token is
opened.  A bin costs its length plus ``bin_cost``.  At the end every bin is downsized
to the least permitted length that holds its contents.  The pieces to come may end
in other bins, so a shard is also packed with each permitted length alone (or what a
piece needs, if more), and the cheapest packing is taken: no fixed length does better.

A null or empty text is one piece of the end mark alone.  Repeated rows are
packed like others.  Null doc_ids are packed as well.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, staged


@dataclass(frozen=True)
class PackParams:
    sizes: tuple[int, ...] = (2_048, 4_096, 8_192, 16_384, 32_768)
    bin_cost: int = 16
    shard_rows: int = 4_096


def _filled(falling: list[int], before: list[int], at: int, room: int) -> int:
    """Tokens that the pieces from ``at`` on bring into a bin with ``room`` left, always the largest that fits.

    ``falling`` holds the lengths negated, ``before`` the tokens ahead of each piece.
    """
    used = 0
    while room > 0:
        at = bisect_left(falling, -room, at)
        if at == len(falling):
            break
        end = bisect_right(before, before[at] + room, at) - 1  # as many in a row as fit
        used, room, at = used + before[end] - before[at], room - (before[end] - before[at]), end
    return used


def best_fit(lengths: list[int], p: PackParams = PackParams()) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the length of each bin.  ``lengths`` falls and is at most the largest size."""
    sizes = sorted(p.sizes)
    fit = lambda n: sizes[min(bisect_left(sizes, n), len(sizes) - 1)]
    falling, before = [-n for n in lengths], [0, *accumulate(lengths)]

    def cheapest(at: int, n: int) -> int:
        """The permitted length of least cost a token for a bin that piece ``at`` opens."""
        def cost(size: int) -> float:
            used = n + _filled(falling, before, at + 1, size - n)
            return (fit(used) + p.bin_cost) / used
        return min(sizes[bisect_left(sizes, n):], key=lambda size: (cost(size), size))

    best: tuple | None = None
    for opened in (cheapest, *(lambda _, n, size=size: max(fit(n), size) for size in sizes)):
        room: list[tuple[int, int]] = []  # (room left, bin), sorted
        used: list[int] = []
        where, offset = [], []
        for at, n in enumerate(lengths):
            k = bisect_left(room, (n, -1))
            if k < len(room):
                left, b = room.pop(k)
            else:
                b, left = len(used), opened(at, n)
                used.append(0)
            where.append(b)
            offset.append(used[b])
            used[b] += n
            if left > n:
                insort(room, (left - n, b))
        caps = [fit(u) for u in used]
        cost = sum(caps) + p.bin_cost * len(caps)
        if best is None or cost < best[0]:
            best = (cost, where, offset, caps)
    return best[1:] if lengths else ([], [], [])


def pieces(docs: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start (byte in the text), n_tokens."""
    most = max(p.sizes)
    n = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    cut = docs.select("doc_id", n.alias("n")).select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most))).alias("piece"))
    return cut.select("doc_id", "piece", (F.col("piece") * most).alias("start"), F.least(F.col("n") - F.col("piece") * most, F.lit(most)).alias("n_tokens"))


def _pack_shard(g: pd.DataFrame, p: PackParams) -> pd.DataFrame:
    g = g.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
    where, offset, caps = best_fit(g["n_tokens"].tolist(), p)
    where = np.array(where, np.int64)
    return g.assign(bin_id=(g["shard"].to_numpy() << 24) + where, bin_size=np.array(caps, np.int64)[where], bin_offset=np.array(offset, np.int64)).drop(columns="shard")


def pack(docs: DataFrame, p: PackParams = PackParams()) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, bin_size, bin_offset of every piece."""
    ship(docs.sparkSession)
    cut = staged(pieces(docs, p), "pack-pieces")
    shards = max(1, -(-cut.count() // p.shard_rows))
    # the row number in the stored pieces, not the id: repeated ids don't meet
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    schema = T.StructType([*cut.schema.fields, T.StructField("bin_id", T.LongType()), T.StructField("bin_size", T.LongType()), T.StructField("bin_offset", T.LongType())])
    return dealt.groupBy("shard").applyInPandas(lambda g: _pack_shard(g, p), schema)
