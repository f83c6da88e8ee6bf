"""Language id, SimHash, toxicity and decontamination against brute force, and on odd tables."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from ledgerline.llm import decontaminate, lang_id, simhash, toxicity
from llm_rows import words


# ---- PPM --------------------------------------------------------------------

def _ppm_bits(train: list[bytes], text: bytes) -> float:
    """Textbook code length: counts of every context up to three bytes, escapes, uniform below."""
    counts: dict[bytes, dict[int, int]] = {}
    for t in train:
        for i, s in enumerate(t):
            for k in range(min(3, i) + 1):
                c = counts.setdefault(t[i - k:i], {})
                c[s] = c.get(s, 0) + 1
    bits = 0.0
    for i, s in enumerate(text):
        for k in range(min(3, i), -1, -1):
            c = counts.get(text[i - k:i])
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if s in c:
                bits -= np.log2(c[s] / (n + d))
                break
            bits -= np.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    r = random.Random(1)
    train = {"a": [words(r, 30, "abcd").encode() for _ in range(4)], "b": [words(r, 30, "cdefé").encode() for _ in range(4)]}
    docs = spark.createDataFrame([(n, t.decode(), lang) for n, (lang, t) in enumerate((k, t) for k, ts in train.items() for t in ts)], "doc_id long, text string, lang string")
    learned = {row["text"].encode(): row["lang"] for row in lang_id.training_sample(docs, lang_id.PpmParams()).collect()}
    model = lang_id.train(docs, lang_id.PpmParams(min_context=1))
    texts = [b"abcd dcba", "cdéf zz".encode(), b"", b"a" * 50, words(r, 400, "abcdef").encode()]
    got = lang_id.code_lengths(model, texts, chunk=64)
    for j, lang in enumerate(model.langs):
        # a context that only the other language has is passed without a cost
        want = [_ppm_bits([t for t, x in learned.items() if x == lang], t) for t in texts]
        assert np.allclose(got[:, j], want), lang


@pytest.mark.parametrize("seed", range(6))
def test_code_lengths_at_every_chunk_border(spark, ppm_model, seed):
    """Empty texts at any place and every chunk from 1 byte on: the same sums as one text at a time."""
    r = random.Random(seed)
    for _ in range(40):
        texts = [b"" if r.random() < 0.4 else words(r, r.randint(1, 6), "abcdefz").encode()[:r.randint(1, 30)] for _ in range(r.randint(1, 9))]
        texts += r.choice([[], [b""], [b"", b""]])
        alone = np.vstack([lang_id.code_lengths(ppm_model, [t], chunk=1 << 19) for t in texts])
        for chunk in {1, 2, 3, r.randint(4, 64), sum(map(len, texts)) + 3 * len(texts)}:
            assert np.allclose(lang_id.code_lengths(ppm_model, texts, chunk=chunk), alone), (texts, chunk)


@pytest.fixture(scope="module")
def ppm_model(spark):
    r = random.Random(5)
    rows = [(i, words(r, 30, "abcd" if i % 2 else "cdef"), "a" if i % 2 else "b") for i in range(16)]
    return lang_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), lang_id.PpmParams(min_context=1))


def test_language_of_an_empty_last_text(spark, ppm_model):
    docs = spark.createDataFrame([(1, "abcd dcba", "a"), (2, "", "a"), (3, None, "a")], "doc_id long, text string, lang string").coalesce(1)
    assert [r["lang_pred"] for r in lang_id.identify(docs, ppm_model).collect()][1:] == ["und", "und"]
    assert [r["doc_id"] for r in lang_id.keep_identified(docs, ppm_model).collect()] == [1]


def test_language_of_odd_rows(odd_docs, no_docs, odd_rows):
    model = lang_id.train(odd_docs)
    got = lang_id.identify(odd_docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["lang_pred"] for r in got}
    assert [by[k] for k in (12, 13, 14, 15)] == ["und"] * 4 and by[0] == by[17] == "x"
    kept = lang_id.keep_identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and {12, 13, 14, 15}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert lang_id.train(no_docs) is None and lang_id.identify(no_docs, model).count() == 0
    assert {r["lang_pred"] for r in lang_id.identify(odd_docs, None).collect()} == {"und"}


# ---- SimHash ------------------------------------------------------------------

def _fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w)] if 0 < len(w) <= k else [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(n, linked):
    label = list(range(n))
    for i, j in linked:
        a, b = label[i], label[j]
        label = [min(a, b) if x in (a, b) else x for x in label]
    return label


def test_trie_pairs_are_all_pairs():
    r = np.random.default_rng(2)
    for trial in range(20):
        centre = r.integers(0, 2 ** 63, 4, dtype=np.uint64)
        flips = np.bitwise_or.reduce(np.uint64(1) << r.integers(0, 64, (200, 3)).astype(np.uint64), 1)
        a = np.unique(np.concatenate([r.choice(centre, 200) ^ flips, centre]))
        b = np.unique(np.concatenate([r.choice(centre, 150) ^ flips[:150], r.integers(0, 2 ** 63, 20, dtype=np.uint64)]))
        got = {(int(x), int(y)) for i, j in simhash.trie_pairs(a, b, 3, at_once=64) for x, y in zip(i, j)}
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if int(a[i] ^ b[j]).bit_count() <= 3}
        assert got == want


def test_leaf_pairs_cover_the_budget():
    r = random.Random(5)
    counts = {x: r.choice([1, 50]) for x in r.sample(range(1 << 16), 3_000)} | {7: 5_000}
    leaves = simhash.cut_leaves(counts, simhash.SimHashParams(leaf_rows=100))
    assert sum(1 << (16 - d) for d, _ in leaves) == 1 << 16
    pairs = set(simhash.leaf_pairs(leaves, 3))
    for (i, (d, x)), (j, (e, y)) in itertools.combinations(list(enumerate(leaves))[::3], 2):
        m = min(d, e)
        assert ((i, j) in pairs) == ((x >> (d - m) ^ y >> (e - m)).bit_count() <= 3)


def test_simhash_groups(spark, odd_docs, odd_rows, no_docs):
    r = random.Random(8)
    base = words(r, 300).split()
    rows = list(odd_rows)
    for n in range(40):
        w = list(base)
        for _ in range(n % 5):
            w[r.randrange(len(w))] = "changed"
        rows.append((100 + n, " ".join(w), "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fp = [_fingerprint(t) for _, t, _ in rows]
    label = _components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 3])
    least = {}
    for (d, _, _), x in zip(rows, label):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    want = sorted((str(d), f"{f:016x}", str(least.get(x))) for (d, _, _), f, x in zip(rows, fp, label))
    got = sorted((str(x["doc_id"]), x["fingerprint"], str(x["component_id"])) for x in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert 10 not in ids and 0 in ids and ids.count(2) == 1 and ids.count(None) == 2 and sum(x in ids for x in (12, 13, 14)) == 1
    assert simhash.near_duplicates(no_docs).count() == 0


def test_keep_one_keeps_versions_of_other_groups(spark):
    r = random.Random(31)
    t = [words(r, 80) for _ in range(5)]
    rows = [(5, t[0]), (5, t[1]), (3, t[1]), (5, t[2]), (5, t[2]), (6, t[0]), (7, t[3]), (7, t[4]), (8, t[4])]
    docs = spark.createDataFrame([(d, x, n) for n, (d, x) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    got = simhash.keep_one(docs).collect()
    assert sorted((x["doc_id"], x["text"]) for x in got) == sorted([(5, t[0]), (3, t[1]), (5, t[2]), (7, t[3]), (7, t[4])])


# ---- toxicity -----------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark, odd_docs, no_docs):
    r = random.Random(4)
    rows, labels = [], []
    for d in range(600):
        bad = d % 4 == 0
        text = words(r, 30).split()
        for _ in range(3 * bad):
            text.insert(r.randrange(30), r.choice(["vileword", "nastyone", "rudething" + r.choice(["s", "est"])]))
        rows.append((d, " ".join(text)))
        labels.append((d, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (6, 1, 7)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, table)
    found = {x["doc_id"]: x["score"] for x in toxicity.score(docs, model).collect()}
    assert np.mean([(found[d] >= 0.5) == bool(t) for d, _, t in labels]) > 0.97
    assert all(0 <= x["score"] <= 1 for x in toxicity.score(odd_docs, model).collect())
    assert toxicity.train(no_docs, table) is None
    assert {x["score"] < 1e-9 for x in toxicity.score(odd_docs, None).collect()} == {True}


def test_label_model_discounts_repeated_voters():
    r = np.random.default_rng(1)
    y = r.random(2_000) < 0.3
    vote = lambda a, b: np.where(y, r.random(2_000) < a, r.random(2_000) < b)
    one = vote(0.8, 0.1)
    votes = np.stack([one, one, one, vote(0.7, 0.05), vote(0.6, 0.1), vote(0.7, 0.1)], 1)
    post, rate, corr = toxicity.label_model(votes, vote(0.8, 0.05).astype(float), 0.3, 60)
    assert ((post >= 0.5) == y).mean() > 0.85 and corr[0, 1] > 0.9 > corr[0, 3]
    assert abs(rate[1, 3] - 0.7) < 0.15 and rate[0, 3] < 0.15


# ---- decontamination ------------------------------------------------------------

def test_masks_hit_every_two_substitutions():
    p = decontaminate.SeedParams()
    for k in range(3):
        for bad in itertools.combinations(range(p.min_words), k):
            assert any(not any(a + i in bad for i, c in enumerate(m) if c == "1") for m in p.masks for a in range(p.min_words - len(m) + 1)), bad


def test_masks_hit_every_accepted_placement():
    p = decontaminate.SeedParams()
    used = [[sum(1 << a + i for i, c in enumerate(m) if c == "1") for a in range(26 - len(m))] for m in p.masks]
    for n in range(p.min_item_words, 26):
        seeds = [s for row in used for s in row if s < 1 << n]
        for bad in itertools.combinations([1 << i for i in range(1, n - 1)], int((1 - p.equal) * n + 1e-9)):
            changed = sum(bad)
            assert any(not s & changed for s in seeds), (n, f"{changed:b}")


def test_accepted_overlaps_are_found_at_all_lengths():
    r = random.Random(12)
    item = [f"w{n}" for n in range(60)]
    for p in (decontaminate.SeedParams(), decontaminate.SeedParams(hits_at_once=3)):
        for n in range(8, 26):
            for _ in range(30):
                part = list(item[:n]) if n < 13 else list(item[20:20 + n])
                changed = r.sample(range(1, n - 1), n // 5)
                for at in changed:
                    part[at] = "other"
                index = decontaminate.build_index([(7, " ".join(item[:n] if n < 13 else item))], p)
                got = decontaminate.overlaps(" ".join(["x"] * 5 + part + ["x"] * 5), index, p)
                assert got == [(0, 5, 0 if n < 13 else 20, n, n - n // 5)], (n, changed)


def _stretch(same, equal):
    best = (0, 0)
    for a in range(len(same)):
        for b in range(a + 1, len(same) + 1):
            if same[a] and same[b - 1] and sum(same[a:b]) >= equal * (b - a) - 1e-9 and b - a > best[1] - best[0]:
                best = (a, b)
    return best


def test_longest_stretch():
    r = random.Random(6)
    for _ in range(300):
        same = [r.random() < r.choice([0.4, 0.8, 0.95]) for _ in range(r.randint(1, 30))]
        a, b = decontaminate.longest_stretch(np.array(same), 0.8)
        x, y = _stretch(same, 0.8)
        assert b - a == y - x and (a == x or a == b), same


def test_leaks_are_found_and_clean_documents_kept(spark, odd_docs, no_docs):
    r = random.Random(7)
    items = [words(r, n, "mnopqrs").split() for n in (8, 13, 20, 50, 7)]
    rows, want = [], set()
    for d in range(60):
        text, i = words(r, 40).split(), d % 5
        part = list(items[i])
        for at in r.sample(range(1, len(part) - 1), d % 3 if len(part) >= 13 else 0):
            part[at] = "other"
        text[10:10] = part if d % 2 else part[:6]
        rows.append((d, " ".join(text).upper() if d % 7 == 0 else ", ".join(text)))
        if d % 2:
            want.add((d, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*((n, " ".join(x)) for n, x in enumerate(items)), (9, None), (10, "")], "item_id long, text string")
    for p in (decontaminate.SeedParams(), decontaminate.SeedParams(block_words=30)):
        got = decontaminate.find_leaks(docs, bench, p).collect()
        assert {(x["doc_id"], x["item_id"]) for x in got} == want
        assert all(x["n_equal"] >= 0.8 * x["n_words"] for x in got)
        kept = {x["doc_id"] for x in decontaminate.drop_leaks(docs, bench, p).collect()}
        assert kept == {d for d, _ in rows} - {d for d, _ in want}
    assert decontaminate.drop_leaks(odd_docs, bench).count() == odd_docs.count()
    few = spark.createDataFrame([(0, "What, IS this?"), (1, "what is that"), (2, "this"), (3, "what is"), (4, "???")], "item_id long, text string")
    said = spark.createDataFrame([(1, "so what is this and what is this"), (2, "what is it"), (3, "is what"), (4, None), (5, "")], "doc_id long, text string")
    got = sorted((x["doc_id"], x["item_id"], x["doc_start"], x["n_words"]) for x in decontaminate.find_leaks(said, few).collect())
    assert got == [(1, 0, 1, 3), (1, 2, 3, 1), (1, 3, 1, 2), (2, 3, 0, 2)]
    assert sorted(x["doc_id"] for x in decontaminate.drop_leaks(said, few).collect()) == [3, 4, 5]
    assert decontaminate.drop_leaks(odd_docs, bench.where("false")).columns == odd_docs.columns
    assert decontaminate.find_leaks(no_docs, bench).count() == 0
