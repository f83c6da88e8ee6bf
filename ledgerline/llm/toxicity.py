"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Voters are mined on a bounded sample of labelled training rows (``per_class``
   whole documents of each class, by a hash of doc_id): words that lean to label
   1 clearly (a lexicon), and word beginnings of ``prefix`` letters that do
   (inflected and compound forms).  Fixed patterns join them: runs of marks,
   shouting in capitals, and several hits of the lexicon.
2. The label model sees votes only; the given label is one more noisy voter, from
   which it starts.  Each voter fires with one probability under each hidden class; expectation maximisation estimates both, and so the
   voter's accuracy.  The covariance that is left between two voters within the
   classes is their correlation, and a voter's evidence is divided by one plus
   the correlations it shares, so that voters that repeat each other count once.
3. The posterior labels train a logistic regression over the presence of the
   words, beginnings and patterns that lean to label 1.  Two numbers, slope
   and offset, are set by the sample's labels at the table's class shares.

Scoring reads only the text; long texts count like short ones, as features are
presences in the whole text.  Null or empty text has no features: its score is the
classifier's offset.  Labels that contradict each other count as 1.  Without a label of
both classes every score is 0.  A null doc_id is never learned from or held out.
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

from ledgerline.llm.common import crc_mod, ship, slices, staged

WORD = re.compile(r"[^\W\d_]+")
PATTERNS = (("#marks", re.compile(r"[!?]{2,}")), ("#many-marks", re.compile(r"(?:[!?]{2,}[^!?]{0,40}){5}")),
            ("#shout", re.compile(r"(?:\b[^\W\d_a-zß-öø-ÿ]{2,}\b\W*){4}")))


@dataclass(frozen=True)
class ToxicParams:
    per_class: int = 3_000
    prefix: int = 5
    voters: int = 96          # mined words and beginnings that vote
    features: int = 1_000     # words and beginnings that the classifier sees
    min_docs: int = 4         # of the sample that hold a mined word
    min_lean: float = 1.4     # log ratio of its rates in the classes
    min_z: float = 5.0        # and its distance from chance
    em_rounds: int = 50
    l2: float = 1.0


@dataclass
class ToxicModel:
    feature: dict[str, int]   # a beginning is kept as "beginning*"
    weight: np.ndarray
    bias: float


def tokens(text: str, prefix: int) -> set[str]:
    """Distinct words, their beginnings marked by ``*``, and patterns that occur, marked by ``#``."""
    w = set(WORD.findall(text.lower()))
    found = w | {x[:prefix] + "*" for x in w if len(x) >= prefix}
    return found | {name for name, pattern in PATTERNS if pattern.search(text)}


def training_rows(docs: DataFrame, labels: DataFrame, p: ToxicParams) -> tuple[DataFrame, dict[int, int]]:
    """(label, text) of the sampled training rows, and the class sizes of all training rows."""
    learn = (labels.where(F.col("toxic").isin(0, 1) & (crc_mod("doc_id", 5) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("label")))
    learn = staged(learn, "toxic-labels")
    sizes = {int(r["label"]): int(r["count"]) for r in learn.groupBy("label").count().collect()}
    w = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = learn.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= p.per_class).select("doc_id", "label")
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id").select("label", "text"), sizes


def _token_rows(prefix: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [sorted(tokens(t, prefix)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("label").cast(pa.int32()), pa.array(found, pa.list_(pa.string()))], ["label", "tokens"])
    return run


def label_model(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row, voters' firing rates [class, voter], correlations."""
    n, j = votes.shape
    v = votes.astype(float)
    post = np.clip(start, 0.02, 0.98)
    share, corr = np.ones(j), np.eye(j)
    rate = np.zeros((2, j))
    for r in range(rounds):
        for c, q in ((0, 1 - post), (1, post)):
            rate[c] = (q @ v + 0.5) / (q.sum() + 1.0)
        if r >= 5:  # correlations within the hidden classes
            cov = sum(((v - rate[c]) * q[:, None]).T @ (v - rate[c]) for c, q in ((0, 1 - post), (1, post))) / n
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = cov / np.outer(sd, sd)
            strong = np.where(corr > 0.2, corr, 0.0)
            np.fill_diagonal(strong, 0.0)
            share = 1.0 / (1.0 + strong.sum(1))
        fire = (np.log(rate[1]) - np.log(rate[0])) * share
        calm = (np.log1p(-rate[1]) - np.log1p(-rate[0])) * share
        logit = np.log(prior / (1 - prior)) + v @ fire + (1 - v) @ calm
        before, post = post, 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if r > 6 and np.abs(post - before).max() < 1e-4:
            break
    return post, rate, corr


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int = 300) -> np.ndarray:
    """Weights (offset last) of a logistic regression on soft labels, by accelerated gradient steps."""
    xb = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(xb.shape[1])
    z, t = w.copy(), 1.0
    total = weight.sum()
    ridge = np.append(np.full(x.shape[1], l2 / total), 0.0)
    step = 1.0 / (0.25 * (xb ** 2).sum(1).max() + l2 / total)
    step = max(step, 1.0 / (0.25 * np.linalg.norm(xb * np.sqrt(weight / total)[:, None], 2) ** 2 + l2 / total))
    for _ in range(rounds):
        g = xb.T @ (weight * (1 / (1 + np.exp(-np.clip(xb @ z, -30, 30))) - y)) / total + ridge * z
        w2 = z - step * g
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = w2 + (t - 1) / t2 * (w2 - w), w2, t2
    return w


def train(docs: DataFrame, labels: DataFrame, p: ToxicParams = ToxicParams()) -> ToxicModel | None:
    ship(docs.sparkSession)
    rows, sizes = training_rows(docs, labels, p)
    rows = staged(rows.mapInArrow(_token_rows(p.prefix), "label int, tokens array<string>"), "toxic-tokens")
    n = {int(r["label"]): int(r["count"]) for r in rows.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        return None
    df = rows.select("label", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum(F.col("label").cast("long")).alias("ones"), F.sum((1 - F.col("label")).cast("long")).alias("zeros"))
    rate1, rate0 = (F.col("ones") + 0.5) / (n[1] + 1.0), (F.col("zeros") + 0.5) / (n[0] + 1.0)
    df = df.where(F.col("ones") + F.col("zeros") >= p.min_docs).withColumn("lean", F.log(rate1 / rate0))
    rate = (F.col("ones") + F.col("zeros")) / (n[0] + n[1])
    z = (rate1 - rate0) / F.sqrt(rate * (1 - rate) * (1 / n[1] + 1 / n[0]) + 1e-12)
    clear = df.withColumn("z", z).where((F.col("z") >= p.min_z) & (F.col("lean") >= p.min_lean)).orderBy(F.desc("z"), "token")
    # both lists are bounded
    voter = [r[0] for r in clear.where("token not like '#%'").limit(p.voters).select("token").collect()]
    names = list(dict.fromkeys([*voter, *(k for k, _ in PATTERNS), *(r[0] for r in clear.limit(p.features).select("token").collect())]))
    feature = {t: i for i, t in enumerate(names)}
    table = F.array(*[F.lit(t) for t in names])
    got = rows.select("label", F.array_intersect("tokens", table).alias("tokens")).collect()  # at most 2 * per_class rows
    x = np.zeros((len(got), len(names)), np.float64)
    y = np.array([r["label"] for r in got], float)
    for i, r in enumerate(got):
        x[i, [feature[t] for t in r["tokens"]]] = 1
    prior = sizes[1] / (sizes[0] + sizes[1])
    as_table = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    sample_prior = n[1] / (n[0] + n[1])
    lex, starts = [feature[t] for t in voter if t[-1] != "*"], [feature[t] for t in voter if t[-1] == "*"]
    hits = x[:, lex + starts].sum(1)
    fixed = x[:, [feature[k] for k, _ in PATTERNS]]
    post, _, _ = label_model(np.hstack([x[:, lex + starts], fixed, (hits >= 2)[:, None], (hits >= 4)[:, None], y[:, None]]), y, sample_prior, p.em_rounds)
    w = logistic(x, post, np.ones(len(post)), p.l2)
    raw = x @ w[:-1] + w[-1]
    slope, offset = logistic(raw[:, None], y, as_table, 1e-3, 2_000)
    return ToxicModel(feature, w[:-1] * slope, float(w[-1] * slope + offset))


def score(docs: DataFrame, model: ToxicModel | None, p: ToxicParams = ToxicParams()) -> DataFrame:
    """doc_id and score (0 to 1) of each row; only ``text`` is read for it."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # at most `features` words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = m.feature.keys() if m else ()
        for b in slices(batches):
            logit = np.full(b.num_rows, m.bias if m else -np.inf)
            for i, t in enumerate(b.column("text").to_pylist() if m else ()):
                found = names & tokens(t, p.prefix) if t else ()
                if found:
                    logit[i] += m.weight[[m.feature[x] for x in sorted(found)]].sum()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(logit, -700, 700))))], ["doc_id", "score"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
