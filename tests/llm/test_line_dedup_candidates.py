"""Line dedup: rarity classes and candidates (check of round 3, CPU seconds a GB)."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerline.llm import line_dedup
from ledgerline.llm.line_dedup import CODE_BITS, LineParams


def test_classes_tell_counts_below_the_mean_bucket_apart(spark):
    p = LineParams(bucket_bits=4)
    pool = spark.createDataFrame([(f"w{k}",) for k in range(200)], "w string").selectExpr("w", f"shiftrightunsigned(xxhash64(w), {64 - p.bucket_bits}) b").collect()
    rare, some, common = {x["b"]: x["w"] for x in pool if x["b"] > 0}[1], *({x["b"]: x["w"] for x in pool}[b] for b in (2, 3))
    text = "\n".join([rare, *[some] * 8, *[common] * 400])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    codes = line_dedup.token_codes(F.lit(f"{common} {rare} {some}"), line_dedup.frequency_classes(docs, p), p)
    got = spark.range(1).select(F.transform(codes, lambda c: F.shiftright(c, CODE_BITS)).alias("k")).first()["k"]
    assert got == [0, 3, 8]


def test_every_similar_pair_is_met_once_by_size(spark):
    """Sizes on both sides of the ratio, either one the earlier, lines of one to sixty words, tabs and blanks among them."""
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)] + ["the"] * 100
    rows = []
    for d in range(60):
        lines = []
        for _ in range(r.randint(1, 4)):
            w = [r.choice(vocabulary) for _ in range(r.choice([1, 4, 5, 9, 20, 36, 60]))]
            for _ in range(r.choice([0, 1, 2])):
                lines.append(r.choice([" ", "\t", "  ", "\x0b \x0c"]).join(w))
                w = w[:len(w) - r.randint(0, max(1, len(w) // 4))] + [f"x{r.randint(0, 50)}" for _ in range(r.randint(0, 3))] or ["w"]
                r.shuffle(w)
            lines.append(r.choice(["", "\t ", "the  the"]))
        r.shuffle(lines)
        rows.append((d, "\n".join(lines)))
    r.shuffle(rows)
    sets = sorted((d, no, frozenset(line.lower().split())) for d, t in rows for no, line in enumerate(t.split("\n")))
    gone = {(d, no) for k, (d, no, w) in enumerate(sets) if w and any(v and len(v & w) * 9 >= (len(v) + len(w)) * 4 for _, _, v in sets[:k])}
    want = {d: "\n".join(x for no, x in enumerate(t.split("\n")) if (d, no) not in gone) for d, t in rows}
    assert len(gone) > 60
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for p in (LineParams(), LineParams(first_size=0, first_sets=2, long_set=8, bucket_bits=6)):
        assert {x["doc_id"]: x["text"] for x in line_dedup.dedup_lines(docs, p).collect()} == want
