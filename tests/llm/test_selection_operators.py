"""Resampling, nearest neighbours and hard negatives against brute force, and on odd tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm import ann, hard_negatives, importance
from llm_rows import words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- importance resampling -----------------------------------------------------

def _features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return len(w), Counter(zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1))


def _resampled(rows, target):
    """[(doc_id, n_features, weight, score, rank)] of rows (doc_id, text), sorted by text form."""
    found = [(k, *_features(t)) for k, t in rows]
    s, t = sum((c for _, _, c in found), Counter()), sum((_features(x)[1] for x in target), Counter())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10000) / ((s[b] + 1) * (t.total() + 10000)))) for b in range(10000)]
    out = []
    for k, n, c in found:
        h = int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] * m for b, m in c.items())
        out.append([k, c.total(), w, None if k is None else w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), n])
    drawn = sorted((r for r in out if r[4] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], -r[2], -r[1]))
    ranks = {id(r): i + 1 for i, r in enumerate(drawn[: 5 * len(drawn) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


def _got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


def test_joined_checksums_of_any_length():
    r = random.Random(1)
    a = [r.randbytes(r.randint(0, 40)) for _ in range(200)]
    b = [r.randbytes(r.choice([0, 1, 3, 17, 300, 5000])) for _ in range(200)]
    got = importance.joined_crc(*(np.array([zlib.crc32(x) for x in xs], np.uint32) for xs in (a, b)), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)]


@pytest.mark.parametrize("at_once", [3, 7, 1 << 17])
def test_buckets_across_blocks_of_words(monkeypatch, at_once):
    r = random.Random(2)
    docs = [words(r, n).upper() for n in (0, 1, 2, 3, 40, 0, 5, 2)] + ["Ünï çode 日本語 x", "a-b_c 9 a-b_c"]
    blocks = importance.word_blocks
    monkeypatch.setattr(importance, "word_blocks", lambda d: blocks(d, at_once))
    pieces = importance._pieces
    monkeypatch.setattr(importance, "_pieces", lambda t: pieces(t, 11))
    doc, bucket, n, n_words = importance.bucket_counts([d.encode() for d in docs], 10000)
    for i, d in enumerate(docs):
        want_words, want = _features(d)
        assert dict(zip(bucket[doc == i].tolist(), n[doc == i].tolist())) == dict(want) and n_words[i] == want_words


def test_planes_sum_exactly():
    r = np.random.default_rng(3)
    for gain in (r.integers(-9000, 9000, 500), r.integers(0, 5, 500), r.integers(-7, 0, 500), np.zeros(500, np.int64), np.array([-1] * 500)):
        count = np.where(r.random((9, 500)) < 0.1, r.integers(1, 300, (9, 500)), 0)
        count[4] = 0
        doc, bucket = np.nonzero(count)
        planes, value = importance.gain_planes(gain)
        assert np.array_equal(importance.weights(doc, bucket, count[doc, bucket], 9, planes, value, 500, at_once=4), count @ gain)


def test_resampling_equals_brute_force(spark):
    r = random.Random(4)
    rows = [(i, words(r, r.choice([0, 5, 19, 20, 21, 60]), "abcdefgh" if i % 3 else "ab")) for i in range(400)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # a third copies
    target = [words(r, 80, "ab") for _ in range(5)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    p = importance.ImportanceParams(rank_rows=4)  # several tasks share the ranks
    assert _got(importance.resample(docs, bench, p)) == _resampled(rows, target)


def test_resampling_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    bench = spark.createDataFrame([("ab cd ef",)], "text string")
    want = _resampled([(k, t) for k, t, _ in odd_rows], ["ab cd ef"])
    got = importance.resample(odd_docs, bench)
    assert _got(got) == want and "lang_pred" not in got.columns
    assert _got(importance.resample(odd_docs, bench.limit(0))) == _resampled([(k, t) for k, t, _ in odd_rows], [])
    assert importance.resample(no_docs, bench).count() == 0
    many = odd_docs.crossJoin(spark.range(8)).drop("id")  # rows repeat
    assert _got(importance.resample(many, bench)) == _resampled([(k, t) for k, t, _ in odd_rows for _ in range(8)], ["ab cd ef"])


# ---- vectors ----------------------------------------------------------------------

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
                        *(T.StructField(c, T.StringType()) for c in ("score", "vec", "slab", "tile", "block", "query", "rank", "turn", "anchor", "sums"))])


def _table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *["!"] * 10) for r in rows], VECTORS).repartition(parts)


def _rows(seed, n, d=24, labels=4, spread=0.4):
    g = np.random.default_rng(seed)
    centre = g.normal(size=(12, d))
    x = (centre[g.integers(0, 12, n)] + spread * g.normal(size=(n, d))).astype(np.float32)
    return [(i, x[i].tolist(), int(g.integers(0, labels))) for i in range(n)]


def _exact_nearest(rows, every, k):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(1))[:, None]
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        c = (x * x[q]).sum(1)
        c[ids == ids[q]] = -9
        order = np.lexsort((ids, -np.round(c, 12)))[:k]
        out[int(ids[q])] = [(int(ids[o]), c[o]) for o in order if c[o] > -9]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_heap_walk_passes_the_nearest_cells():
    g = np.random.default_rng(5)
    for _ in range(50):
        d1, d2, size = g.integers(0, 6, 5) / 1.0, g.integers(0, 6, 7) / 1.0, g.integers(0, 4, (5, 7))
        far = (d1[:, None] + d2).reshape(-1)
        order = np.argsort(far, kind="stable")
        passed = size.reshape(-1)[order].cumsum()
        for budget in (1, 5, 20, 1000):
            at = np.searchsorted(passed, budget)
            want = far[order][at] if at < len(order) else np.inf
            assert ann.walk(d1, d2, size, [budget]) == [want]


def test_neighbours_reach_the_recall(spark):
    rows = _rows(6, 3000)
    p = ann.IndexParams(every=10, cell_rows=8, probe=64, block=100, sample=1000)
    got, want = _found(ann.nearest(_table(spark, rows), p)), _exact_nearest(rows, 10, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit / sum(map(len, want.values())) >= 0.9
    for q, found in got.items():  # scores are the cosines, in order
        x = {i: np.array(v) for i, v, _ in rows}
        for i, s in found:
            assert abs(s - x[q] @ x[i] / np.sqrt((x[q] @ x[q]) * (x[i] @ x[i]))) < 1e-12
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_neighbours_with_whole_budget_are_exact_on_ties_and_copies(spark):
    rows = _rows(7, 200, d=6)
    rows += [(1000 + i, rows[3][1], 0) for i in range(150)] + [(2000 + i, [2 * v for v in rows[3][1]], 0) for i in range(10)]
    p = ann.IndexParams(every=10, cell_rows=8, recall=1.0, probe=10_000)
    assert {q: [i for i, _ in v] for q, v in _found(ann.nearest(_table(spark, rows), p)).items()} == {q: [i for i, _ in v] for q, v in _exact_nearest(rows, 10, 5).items()}


def test_neighbours_of_odd_rows(spark):
    good = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (50, [1e30, 0.0], 1), (3, [-1.0, 0.1], 1)]
    other = [(100, [1.0, 2.0, 3.0], 1), (101, [1.0, 2.0, 3.5], 1), (150, [7.0], 1)]
    odd = [(7, None, 1), (8, [], 1), (9, [0.0, 0.0], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1), (12, [None, 1.0], 1), (200, [0.0, 0.0], 1)]
    got = _found(ann.nearest(_table(spark, good + other + odd)))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [50, 1, 3], 50: [0, 1, 3], 100: [101]}
    assert abs(got[0][0][1] - 1.0) < 1e-12
    assert ann.nearest(_table(spark, odd)).count() == 0 and ann.nearest(_table(spark, [])).count() == 0
    assert ann.nearest(_table(spark, [(1, [1.0], 0)])).count() == 0


# ---- hard negatives ---------------------------------------------------------------

def _exact_negatives(rows, p):
    rows = [(i, np.floor(256 * np.array(v, np.float64)), c) for i, v, c in rows]
    out = []
    for a, x, label in rows:
        if a % p.anchors:
            continue
        near = sorted((-int(x @ y), i) for i, y, c in rows if i != a and c == label)[: p.positives]
        far = sorted((-int(x @ y), i) for i, y, c in rows if i != a and c != label)
        for s, pos in near:
            fits = [(t, i) for t, i in far if 30 * -s <= 100 * -t <= 90 * -s][: p.negatives]
            out += [(a, pos, n + 1, i, -s, -t) for n, (t, i) in enumerate(fits)]
    return sorted(out)


def _mined(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def test_bounds_hold():
    g = np.random.default_rng(8)
    for d in (1, 3, 4, 16, 20, 64):
        x, y = (np.floor(256 * g.normal(size=(40, d))) for _ in range(2))
        for n in (16, 4):
            a, b = hard_negatives.summary(x, n), hard_negatives.summary(y, n).astype(np.float32).astype(float)
            slack = np.sqrt((x * x).sum(1)) * (2e-6 * np.sqrt((y * y).sum(1)).max()) + 0.01
            least, most = hard_negatives.bounds(a, b, slack[:, None])
            assert (least <= x @ y.T).all() and (x @ y.T <= most).all()
            u, v = np.divmod(np.arange(1600), 40)
            least, most = hard_negatives.pair_bounds(a[u], b[v], slack[u])
            assert (least <= (x @ y.T)[u, v]).all() and ((x @ y.T)[u, v] <= most).all()


def test_window_of_every_score():
    p, s = hard_negatives.NegativeParams(), np.arange(-250, 251)
    low, high = hard_negatives.window(s, p)
    for t, lo, hi in zip(s.tolist(), low.tolist(), high.tolist()):
        assert [n for n in range(-300, 301) if 30 * t <= 100 * n <= 90 * t] == list(range(lo, hi + 1))


@pytest.mark.parametrize("dense", [0.0, 1.1])
def test_negatives_equal_brute_force(spark, dense):
    rows = _rows(9, 700, spread=1.0)
    rows += [(2000 + i, rows[5][1], i % 2) for i in range(200)] + [(3000 + i, [0.01 * (i % 3)] * 24, 1) for i in range(60)]  # copies and ties
    p = hard_negatives.NegativeParams(anchors=20, block=16, first=4, dense=dense)
    want = _exact_negatives(rows, p)
    assert len(want) > 500 and _mined(hard_negatives.mine(_table(spark, rows), p)) == want


def test_negatives_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.5, 0.2], 2), (3, [-1.0, 0.0], 2), (4, [0.4, 0.0], 0), (5, [0.99, 0.0], 2), (100, [0.0, 1.0], 3)]
    odd = [(200, None, 1), (300, [], 1), (7, [1.0, None], 1), (8, [float("nan"), 0.0], 1), (9, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (400, [1e20, 0.0], 1), (10, [1.0], 1), (11, [0.5], 2)]
    p = hard_negatives.NegativeParams()
    got = _mined(hard_negatives.mine(_table(spark, rows + odd), p))
    assert got == _exact_negatives(rows, p) and {r[3] for r in got} == {2, 4}
    again = _mined(hard_negatives.mine(_table(spark, rows + [rows[2], rows[1]] + odd), p))
    assert again == _exact_negatives(rows + [rows[2], rows[1]], p)  # repeated rows are rows of their own
    assert hard_negatives.mine(_table(spark, odd)).count() == 0 and hard_negatives.mine(_table(spark, [])).count() == 0
