"""Vectors of Arrow batches as numpy matrices, and bounded hash samples of tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix in double precision) of each length among the usable vectors.

    A vector is usable if it is not null, not empty, and holds neither null
    nor non-finite components.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.fill_null(lists.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = (sizes > 0) & (broken[ends] == broken[ends - sizes])
    for d in np.unique(sizes[usable]):
        rows = np.flatnonzero(usable & (sizes == d))
        yield rows, flat[(ends[rows] - d)[:, None] + np.arange(d)]


def first_of_equal(key: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Rows to keep so that every search for the ``n`` smallest ids among equal rows of ``key`` finds them,
    also when it leaves out any one id: those of the first ``n + 1`` ids, ``n`` repeats of each."""
    if not len(ids):
        return np.zeros(0, np.int64)
    whole = np.ascontiguousarray(key).view(np.dtype((np.void, key.shape[1] * key.itemsize))).reshape(-1)
    group = np.unique(whole, return_inverse=True)[1].reshape(-1)
    order = np.lexsort((ids, group))
    g, i, at = group[order], ids[order], np.arange(len(order))
    opens_group = np.concatenate([[True], g[1:] != g[:-1]])
    opens_id = opens_group | np.concatenate([[True], i[1:] != i[:-1]])
    number = np.cumsum(opens_id)
    number -= number[np.maximum.accumulate(np.where(opens_group, at, 0))]
    repeat = at - np.maximum.accumulate(np.where(opens_id, at, 0))
    return order[(number <= n) & (repeat < n)]


def hash_share(rows: int, wanted: int, *cols: str, seed: int) -> Column:
    """Condition that about ``wanted`` of ``rows`` rows meet, by a hash of ``cols``."""
    share = min(1.0, wanted / max(1, rows))
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) < int(share * (1 << 30))


def lengths(rows: DataFrame, name: str) -> list[int]:
    """The lengths of vectors that occur; each is searched apart."""
    return sorted(r[0] for r in rows.select(F.size(name).alias("n")).where("n > 0").distinct().collect())


def blocks(spark: SparkSession, path: str, kind: str, size: int) -> Iterator[list]:
    """The rows of a stored table, whose files hold at most ``size``, in lists of less than twice ``size``; small files share a list."""
    files, got, at, per_read = sorted(spark.read.schema(kind).parquet(path).inputFiles()), [], 0, 64
    while at < len(files):
        part = spark.read.schema(kind).parquet(*files[at:at + per_read])
        if per_read > 1 and part.count() > size:
            per_read = max(1, per_read // 2)
            continue
        got += part.collect()  # at most ``size`` rows
        at += per_read
        if len(got) >= size:
            yield got
            got = []
    if got:
        yield got
