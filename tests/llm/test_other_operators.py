"""Packing, suffix sorting, chat, personal data, embeddings, line dedup and the pipeline."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import chat, components, embeddings, line_dedup, packing, pii, suffix
from llm_rows import words

SF = "/root/testdata/sf0.001"


def test_components_of_a_chain_a_star_and_repeats(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (300, 101), (500, 501), (501, 500)], "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)} | {500: 500, 501: 500}
    assert got == want
    assert components.components(edges.where("false")).count() == 0


# ---- packing ----------------------------------------------------------------------

def test_packing_holds_everything_once(odd_docs, no_docs):
    p = packing.PackParams(sizes=(64, 256, 1024), shard_rows=8)
    rows = packing.pack(odd_docs, p).collect()
    total = sum(len((r["text"] or "").encode()) + 1 for r in odd_docs.select("text").collect())
    assert sum(r["n_tokens"] for r in rows) == total
    bins: dict = {}
    for r in rows:
        bins.setdefault((r["bin_id"], r["bin_size"]), []).append((r["bin_offset"], r["n_tokens"]))
    for (_, size), parts in bins.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= size and size == min(s for s in p.sizes if s >= at)
    assert len({b for b, _ in bins}) == len(bins)
    assert packing.pack(no_docs, p).count() == 0


def test_best_fit_takes_the_tightest_bin_and_beats_one_size():
    p = packing.PackParams(sizes=(10, 20), bin_cost=0)
    where, offset, caps = packing.best_fit([9, 8, 6, 4, 2, 1], p)
    assert caps == [10, 10, 10] and where == [0, 1, 2, 2, 1, 0]
    r = random.Random(2)
    lengths = sorted((r.randint(1, 30_000) for _ in range(500)), reverse=True)
    cost = lambda p: sum(packing.best_fit(lengths, p)[2])
    assert cost(packing.PackParams()) <= cost(packing.PackParams(sizes=(32_768,)))
    assert cost(packing.PackParams()) < 1.05 * sum(lengths)
    assert packing.best_fit([]) == ([], [], [])


def _least_cost(lengths, p):
    """Cheapest division of the pieces into bins, by trying all."""
    best = [float("inf")]

    def go(at, bins, _):
        if at == len(lengths):
            best[0] = min(best[0], sum(min(s for s in p.sizes if s >= b) + p.bin_cost for b in bins))
            return
        for k in range(len(bins)):
            if bins[k] + lengths[at] <= max(p.sizes):
                go(at + 1, [*bins[:k], bins[k] + lengths[at], *bins[k + 1:]], None)
        go(at + 1, [*bins, lengths[at]], None)

    go(0, [], None)
    return best[0]


def test_openings_weigh_all_lengths():
    total = lambda x, p: sum(packing.best_fit(x, p)[2]) + p.bin_cost * len(packing.best_fit(x, p)[2])
    p = packing.PackParams()
    same = [100] * 4_096
    assert total(same, p) == 12 * 32_784 + 16_400 + 2_064  # full large bins, then what is left in the least that holds it
    r = random.Random(3)
    for n in range(40):
        x = sorted((r.choice([r.randint(1, 300), r.randint(1, 5_000), r.randint(1, 32_768)]) for _ in range(r.randint(1, 300))), reverse=True)
        for size in p.sizes:  # no permitted length alone is cheaper
            assert total(x, p) <= total(x, packing.PackParams(sizes=tuple(s for s in p.sizes if s >= size)))
    p, ours, least = packing.PackParams(sizes=(10, 16, 30), bin_cost=1), 0, 0
    for n in range(60):
        x = sorted((r.randint(1, 16) for _ in range(r.randint(1, 7))), reverse=True)
        a, b = total(x, p), _least_cost(x, p)
        assert b <= a <= 1.5 * b
        ours, least = ours + a, least + b
    assert ours <= 1.05 * least


# ---- suffix sorting ---------------------------------------------------------------

def test_suffix_order_is_the_suffix_array():
    r = random.Random(1)
    for _ in range(200):
        s = [r.randint(1, r.choice([1, 2, 3, 9])) for _ in range(r.randint(0, 60))] + [0]
        assert suffix.suffix_order(np.array(s)) == sorted(range(len(s)), key=lambda i: s[i:])


def _remove(texts, length):
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest(), kept))
    return out


def test_repeats_equal_brute_force(spark, odd_rows, no_docs):
    r = random.Random(9)
    base = [bytes(r.choice(b"ab cd") for _ in range(700)).decode() for _ in range(3)]
    rows = [(d, t) for d, t, _ in odd_rows] + [(200, "a" * 500), (201, "b" * 399 + "c"), (202, "ab" * 300), (203, "x" * 400), (204, "x" * 400)]
    for n in range(30):
        b = base[n % 3]
        cut = b[r.randint(0, 100):r.randint(450, 700)]
        if n % 4 == 0:
            at = r.randrange(len(cut))
            cut = cut[:at] + "é" + cut[at:]
        rows.append((300 + n, words(r, 20) + cut + (words(r, 30) + base[0][:430] if n % 5 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(zip([str(d) for d, _ in rows], *zip(*[x[:4] for x in _remove([(t or "").encode() for _, t in rows], 400)])))
    for p in (suffix.SuffixParams(), suffix.SuffixParams(bucket_bytes=2_000, segment=900, broadcast_bytes=0)):
        got = suffix.remove_repeats(docs, p).collect()
        assert sorted((str(x["doc_id"]), x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got) == want
    assert suffix.remove_repeats(no_docs).count() == 0


def test_a_short_passage_in_many_documents_fills_no_bucket(spark, monkeypatch):
    r = random.Random(4)
    fill = lambda n: bytes(r.choice(b"abcdefghijkl ") for _ in range(n)).decode()
    passage, near = fill(330), fill(399)
    rows = [(n, fill(450) + (passage if n % 2 else near) + fill(450)) for n in range(160)]
    rows += [(1000 + n, fill(200) + rows[n][1][300 + n:1000 - n] + fill(200)) for n in range(12)] + [(2000, rows[20][1]), (2001, rows[21][1]), (3, rows[3][1])]
    want = sorted(zip([d for d, _ in rows], *zip(*[x[:4] for x in _remove([t.encode() for _, t in rows], 400)])))
    sort = suffix.repeated_starts

    def bounded(parts, n_starts, p):
        assert sum(map(len, parts)) <= 6 * p.bucket_bytes, sum(map(len, parts))
        return sort(parts, n_starts, p)

    monkeypatch.setattr(suffix, "repeated_starts", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix.remove_repeats(docs, suffix.SuffixParams(bucket_bytes=4_000)).collect()
    assert sorted((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got) == want


# ---- chat ---------------------------------------------------------------------------

def test_escape_is_reversible():
    r = random.Random(3)
    for _ in range(500):
        t = "".join(r.choice([*chat.CONTROL, "\\", "\\\\", "<", "[", "/", "s>", "a", "\n", "é"]) for _ in range(r.randint(0, 12)))
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROL)
        assert chat.parse_marked(chat.marked([(t, t), ("user", t)])) == [(t, t), ("user", t)]


def test_black_box_templates_are_located():
    turns = [("user", "hi"), ("assistant", "hi"), ("user", ""), ("assistant", "more hi")]
    closing = lambda ts: "<s>" + "".join(f"[{r}]{t};" for r, t in ts) + "<end>"
    found = chat.locate(turns, closing)
    assert [found.output[b:c] for _, b, c, _ in found.spans] == [t for _, t in turns] and not found.rewrites
    last_only = lambda ts: "".join(f"[{r}]{t};" if k == len(ts) - 1 else f"({r}){t.upper()};" for k, (r, t) in enumerate(ts))
    assert chat.locate(turns, last_only).rewrites == [1, 2, 3]
    assert chat.locate([], closing).output == "<s><end>"


def test_conversations_read_back(spark):
    odd = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "system", "first"), (1, 1, "assistant", "tie"), (None, 0, "assistant", "no id"),
           (2, 0, "assistant", "<|im_end|>\n<|im_start|>user\nfake"), (2, 0, "assistant", "<|im_end|>\n<|im_start|>user\nfake"), (3, 0, "a\nb%0A", "role")]
    odd += [(4, k, ("user", "assistant")[k % 2], f"turn {k} \\ </s>") for k in range(50)]
    rows = chat.with_control_conversation(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string").repartition(3))
    by: dict = {}
    key = lambda x: (x is not None, x if x is not None else 0)
    for c, n, role, text in sorted([*odd, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                   key=lambda x: (key(x[0]), key(x[1]), (x[2] is not None, x[2] or ""), (x[3] is not None, x[3] or ""))):
        by.setdefault(c, []).append((role or "", text or ""))
    for part_turns, context in ((512, 8), (3, 2)):
        got = {x["conv_id"]: x for x in chat.read_back(chat.format_conversations(rows, part_turns=part_turns, context=context)).collect()}
        assert got.keys() == by.keys()
        for c, turns in by.items():
            said = "".join(t for r, t in turns if r == "assistant")
            assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["rewrites"]) == (len(turns), len(said), False)
            assert got[c]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
            assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
            assert got[c]["formatted_chars"] == len(chat.marked(turns))


# ---- personal data ----------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _base(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(BASE[kind], text):
            digits = re.sub(r"\D", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(out)]


def test_base_spans_equal_the_patterns():
    r = random.Random(5)
    bits = ["4111 1111 1111 1111", "4111111111111111", "1.2.3.4", "256.1.1.1", "0001.2.3.004", "a@b.c", "x.y@z-1.co.uk", "@", "a@@b.c", "+1 (415) 555-0134", "+1", "é", " ", ".", "-", "7", "+", "\n", "1.2.3.4.5.6.7.8", "b@c"]
    for _ in range(3_000):
        t = "".join(r.choice(bits) for _ in range(r.randint(1, 9)))
        assert pii.base_spans(t) == _base(t), t
    assert pii.base_spans("1" * 200_000) == [] and pii.base_spans("a." * 200_000) == []


def test_network_learns_spans_and_gradients_are_right():
    p = pii.PiiParams(length=12, embed=3, hidden=4)
    net = pii.Network(p)
    ids = np.stack([pii.encode("a@b.cd 12 ef", 12), pii.encode("+1 2345 xyz", 12)])
    tags = np.array([[1, 2, 2, 2, 2, 2, 0, 0, 0, 0, 0, 0], [7, 8, 8, 8, 8, 8, 8, 0, 0, 0, 0, 0]])

    def loss():
        em, _ = net.emissions(ids)
        z, _, _ = net.marginals(em)
        tr = net.w["trans"] + net.barred
        gold = sum(em[i, np.arange(12), t].sum() + tr[t[:-1], t[1:]].sum() + net.start[t[0]] for i, t in enumerate(tags))
        return (z.sum() - gold) / len(ids)

    weights = {k: v.copy() for k, v in net.w.items()}
    net.step(ids, tags, 0.0)
    grads = {k: m[0] / 0.1 for k, m in net.moments.items()}
    r = np.random.default_rng(0)
    for name, w in net.w.items():
        at = tuple(r.integers(0, n) for n in w.shape) if name != "emb" else (int(ids[0, 0]), 1)
        w[at] += 1e-5
        up = loss()
        w[at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - grads[name][at]) < 1e-5, name
        w[at] = weights[name][at]
    before = loss()
    for _ in range(60):
        net.step(ids, tags, 0.05)
    assert loss() < 0.1 < before and (net.decode(ids)[0] == tags).all()


def test_reconcile_keeps_base_spans():
    text = "call 415 555 0134 or +1 415 555 0199 now"
    base = pii.base_spans(text)
    added = [(0.95, (5, 17, "phone")), (0.99, (22, 36, "phone")), (0.93, (5, 12, "phone")), (0.5, (37, 40, "phone"))]
    assert pii.reconcile(base, added, text, 0.9) == [(5, 17, "phone"), *base]


def test_personal_data_of_odd_rows(spark, odd_docs, no_docs):
    rows = pii.find(odd_docs, None).collect()
    assert len(rows) == odd_docs.count() and all(x["base_sha256"] == hashlib.sha256(x["spans"].encode()).hexdigest() for x in rows)
    assert pii.train(no_docs) is None and pii.find(no_docs, None).count() == 0
    net = pii.Network(pii.PiiParams())
    docs = spark.createDataFrame([(1, "mail a@b.co " + "word " * 300 + "ip 10.0.0.1"), (2, None)], "doc_id long, text string")
    got = {x["doc_id"]: x for x in pii.find(docs, net).collect()}
    assert (got[1]["n_email"], got[1]["n_ip"], got[2]["spans"]) == (1, 1, "") and "email:5:11" in got[1]["spans"]


# ---- embeddings ---------------------------------------------------------------------

def test_embedding_links_equal_brute_force(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(400, 20))
    for i in range(100, 400):  # chains and clusters around the threshold
        x[i] = x[r.integers(0, i)] + r.normal(size=20) * r.choice([0, 0.15, 0.3, 0.4])
    rows = [(int(i), [float(np.float32(v)) for v in row], 0) for i, row in enumerate(x)]
    odd = [(1000, None, 1), (1001, [0.0] * 20, 1), (1002, [None] + [1.0] * 19, 1), (1003, [float("nan")] + [1.0] * 19, 1), (1004, [float("inf")] + [1.0] * 19, 1), (1005, [1.0], 1), (1006, [], 1), (None, rows[0][1], 1)]
    table = spark.createDataFrame([*rows, (1007, rows[5][1], 1), (5, rows[5][1], 1), *odd], "vec_id long, embedding array<float>, label int").repartition(3)
    ids = [i for i, *_ in rows] + [1007, 5]
    v = np.array([e for _, e, _ in rows] + [rows[5][1]] * 2)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near = v @ v.T >= 0.95
    label = list(range(len(v)))
    for i, j in zip(*np.nonzero(near)):
        a, b = label[i], label[j]
        if a != b:
            label = [min(a, b) if q in (a, b) else q for q in label]
    least = {}
    for i, q in zip(ids, label):
        least[q] = min(i, least.get(q, i))
    want = sorted((i, int(n) - 1, least[q], i == least[q]) for i, n, q in zip(ids, near.sum(1), label))
    for p in (embeddings.EmbeddingParams(), embeddings.EmbeddingParams(leaf_rows=40, block_dims=6, sample=200)):
        got = embeddings.near_duplicates(table, p).collect()
        lone = [x for x in got if x["vec_id"] is None or 1000 <= x["vec_id"] < 1007]
        assert sorted(tuple(x) for x in got if x not in lone) == want
        assert len(lone) == len(odd) and all(x["n_links"] == 0 and x["component_id"] == x["vec_id"] and x["kept"] for x in lone)
    assert embeddings.near_duplicates(table.where("false")).count() == 0


def test_embeddings_of_several_lengths_are_joined_apart(spark):
    r = np.random.default_rng(4)
    rows = [(100 * d + i, [float(v) for v in r.normal(size=d)]) for d in (1, 8, 32) for i in range(3)]
    rows += [(n + 50, v) for n, v in rows if n % 100 == 0]  # a copy of the first of each length
    table = spark.createDataFrame([*rows, (9, None)], "vec_id long, embedding array<double>")
    got = {x["vec_id"]: (x["n_links"], x["component_id"], x["kept"]) for x in embeddings.near_duplicates(table).collect()}
    assert len(got) == len(rows) + 1 and got[9] == (0, 9, True)
    for d in (8, 32):
        assert got[100 * d] == (1, 100 * d, True) and got[100 * d + 50] == (1, 100 * d, False)
        assert got[100 * d + 1] == (0, 100 * d + 1, True)
    signs = {n: v[0] > 0 for n, v in rows if n < 200}  # vectors of one component: equal signs link
    assert all(got[n][0] == sum(x == s for x in signs.values()) - 1 for n, s in signs.items())


# ---- line dedup -----------------------------------------------------------------------

def _dedup(rows):
    lines = [(d, n, line, set(w for w in re.split(r"[ \t\r\x0b\x0c]+", line.lower()) if w)) for d, t in rows if t is not None for n, line in enumerate(t.split("\n"))]
    gone = set()
    for d, n, _, w in lines:
        if w and any(v and (e, m) < (d, n) and len(v & w) * 9 >= (len(v) + len(w)) * 4 for e, m, _, v in lines):
            gone.add((d, n))
    return {d: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, t in rows}


def test_lines_equal_brute_force(spark, odd_docs, no_docs):
    r = random.Random(11)
    pool = [words(r, r.choice([1, 2, 4, 5, 9, 20, 130]), "abcdefghijkl") for _ in range(25)]
    rows = [(90, None), (91, ""), (92, "\n \n"), (93, pool[0])]
    for d in range(80):
        lines = []
        for _ in range(r.randint(1, 5)):
            w = r.choice(pool).split()
            for _ in range(r.choice([0, 0, 1, 2, len(w) // 8])):
                w[r.randrange(len(w))] = "".join(r.choice("abcdefghijkl") for _ in range(3))
            r.shuffle(w)
            lines.append(r.choice(["", " "]) + " ".join(w).replace("a", r.choice("aA")))
        rows.append((d, "\n".join([*lines, ""] if d % 3 else lines)))
    want = _dedup(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for p in (line_dedup.LineParams(), line_dedup.LineParams(bucket_bits=4, first_codes=1, long_set=4, broadcast_bytes=0)):
        assert {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(docs, p).collect()} == want
    out = line_dedup.drop_repeated_lines(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [x["doc_id"] for x in out.collect()]
    assert 10 not in ids and {0, 12, 13, 14, 18} <= set(ids)
    assert all(x["n_lines"] == "n_lines!" for x in out.collect())
    assert line_dedup.dedup_lines(no_docs).count() == 0


def test_lines_of_null_and_repeated_ids_are_told_apart(spark):
    r = random.Random(21)
    pool = [words(r, 20) for _ in range(12)]
    near = lambda k: pool[k] + " changed"
    rows = [(1, pool[0]), (2, pool[1]), (None, near(0) + "\n" + pool[2]), (None, pool[3] + "\n" + pool[4]), (None, pool[5]), (None, pool[5] + "\n" + near(4)),
            (None, pool[8]), (None, pool[8]), (7, near(1) + "\n" + pool[6]), (7, pool[7] + "\n" + pool[7]), (7, pool[9]), (7, pool[9]), (8, near(6)), (8, pool[10])]
    docs = spark.createDataFrame([(d, t, n) for n, (d, t) in enumerate(rows)], "doc_id long, text string, n int").repartition(3)
    th = {x["n"]: x["th"] for x in docs.selectExpr("n", "xxhash64(text) th").collect()}
    place = [(d is None, d or 0, th[n]) for n, (d, _) in enumerate(rows)]
    lines = [(place[n], k, line, set(line.split())) for n, (_, t) in enumerate(rows) for k, line in enumerate(t.split("\n"))]
    gone = {(a, k) for a, k, _, w in lines if any((b, m) < (a, k) and len(v & w) * 9 >= (len(v) + len(w)) * 4 for b, m, _, v in lines)}
    want = sorted((str(d), "\n".join(x for k, x in enumerate(t.split("\n")) if (place[n], k) not in gone)) for n, (d, t) in enumerate(rows))
    for p in (line_dedup.LineParams(), line_dedup.LineParams(bucket_bits=4, broadcast_bytes=0)):
        assert sorted((str(x["doc_id"]), x["text"]) for x in line_dedup.dedup_lines(docs, p).collect()) == want
    left = {x["n"] for x in line_dedup.drop_repeated_lines(docs).collect()}
    assert left == {n for n, (_, t) in enumerate(rows) if any((place[n], k) not in gone for k in range(len(t.split("\n"))))}


# ---- pipeline ---------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.count()]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).toPandas(), docs.schema)
        assert now.columns == docs.columns
        seen.append(now.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] < seen[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    assert {x["doc_id"] for x in packed.select("doc_id").distinct().collect()} == {x["doc_id"] for x in now.select("doc_id").collect()}
