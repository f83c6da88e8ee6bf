"""Personal data: exact base patterns, and a character BiLSTM-CRF that adds spans.

Base spans (email, ip, card, phone) are found by linear scans of the whole text.
The network is a bidirectional LSTM over characters with CRF transitions between
begin/inside/outside tags of the four kinds, trained in numpy from labelled
spans: windows of a bounded sample of documents with their base spans, copies in
which a span is rewritten in a form that the base patterns miss (other
separators, no country code), and windows without a span.

Every kind of span holds a digit or ``@``, so only windows around those
characters can be tagged; all others decode to no span and are skipped.
Windows overlap by half.  Each is decoded by itself; spans cut by a window's
edge are dropped, as the next window has them whole, and the remaining spans of
a document are reconciled: base spans stay, and of added spans that
overlap the one with the higher probability wins.

n_email to n_phone count base spans.  Null text is empty and has no span.  Without a
span to learn from only base spans are returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, slices

Span = tuple[int, int, str]
KINDS = ("email", "ip", "card", "phone")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then kind."""
    if not _TRIGGER.search(text):
        return []
    found: list[tuple[int, int, int]] = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        last = m.end() if m else at + 1
        if m:
            found.append((start, 0, last))
        at = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(s, e, KINDS[k]) for s, k, e in sorted(found)]


# ---- characters and tags ----------------------------------------------------

_SHOWN = " \n@._%+-()/:,;=\"'<>[]#&|*!?"
N_CHARS = 1 + 10 + 26 + 1 + len(_SHOWN) + 1  # padding, digits, letters, other letters, marks, others
N_TAGS = 1 + 2 * len(KINDS)                  # outside; begin and inside of each kind
_CODE = np.zeros(128, np.int64)
for _c in range(128):
    _s = chr(_c)
    _CODE[_c] = (1 + int(_s) if _s.isdigit() else 11 + ord(_s.lower()) - 97 if _s.isalpha()
                 else 38 + _SHOWN.index(_s) if _s in _SHOWN else N_CHARS - 1)


def encode(text: str, length: int) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(length, np.int64)
    out[:len(cp)] = np.where(cp < 128, _CODE[np.minimum(cp, 127)], 37)
    return out


@dataclass(frozen=True)
class PiiParams:
    docs: int = 4_000         # documents sampled for training (a bound on rows, whole texts)
    windows: int = 3_000      # training windows taken from them
    length: int = 96
    embed: int = 12
    hidden: int = 20
    steps: int = 360
    batch: int = 48
    seed: int = 5
    least: float = 0.9        # probability that an added span needs


class Network:
    """Embedding, two LSTMs, a tag layer and CRF transitions; gradients by hand, Adam."""

    def __init__(self, p: PiiParams):
        r = np.random.default_rng(p.seed)
        e, h = p.embed, p.hidden
        init = lambda *s: r.normal(0, 1 / np.sqrt(s[0]), s)
        self.w = {"emb": r.normal(0, 0.3, (N_CHARS, e)), "out": init(2 * h, N_TAGS), "outb": np.zeros(N_TAGS), "trans": np.zeros((N_TAGS, N_TAGS))}
        for d in "fb":
            self.w |= {f"wx{d}": init(e, 4 * h), f"wh{d}": init(h, 4 * h), f"b{d}": np.repeat([0.0, 1.0, 0.0, 0.0], h)}
        # inside only after begin or inside of its kind
        self.barred = np.zeros((N_TAGS, N_TAGS))
        for t in range(2, N_TAGS, 2):
            self.barred[:, t] = -1e4
            self.barred[[t - 1, t], t] = 0
        self.start = np.where(np.arange(N_TAGS) % 2 == 0, -1e4, 0.0)
        self.start[0] = 0
        self.h, self.moments, self.steps = h, {}, 0

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        n, length, _ = x.shape
        h, c, hs, cache = np.zeros((n, self.h)), np.zeros((n, self.h)), np.zeros((n, length, self.h)), []
        pre = x @ self.w["wx" + d] + self.w["b" + d]
        k = self.h
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a = pre[:, t] + h @ self.w["wh" + d]
            g = 1 / (1 + np.exp(-a[:, :3 * k]))
            u = np.tanh(a[:, 3 * k:])
            before_h, before_c = h, c
            c = g[:, k:2 * k] * c + g[:, :k] * u
            tc = np.tanh(c)
            h = g[:, 2 * k:] * tc
            hs[:, t] = h
            if keep:
                cache.append((t, before_h, before_c, g, u, tc))
        return hs, cache

    def emissions(self, ids: np.ndarray, keep: bool = False):
        x = self.w["emb"][ids]
        f, cf = self._lstm(x, "f", keep)
        b, cb = self._lstm(x, "b", keep)
        both = np.concatenate([f, b], 2)
        return both @ self.w["out"] + self.w["outb"], (x, both, cf, cb)

    def marginals(self, em: np.ndarray):
        """Log partition, tag probabilities and expected transitions of each window."""
        n, length, k = em.shape
        tr = self.w["trans"] + self.barred
        alpha, beta = np.zeros_like(em), np.zeros_like(em)
        alpha[:, 0] = em[:, 0] + self.start
        for t in range(1, length):
            alpha[:, t] = em[:, t] + _lse(alpha[:, t - 1][:, :, None] + tr, 1)
        for t in range(length - 2, -1, -1):
            beta[:, t] = _lse((em[:, t + 1] + beta[:, t + 1])[:, None, :] + tr, 2)
        z = _lse(alpha[:, -1], 1)
        prob = np.exp(alpha + beta - z[:, None, None])
        moves = np.zeros((k, k))
        for t in range(1, length):
            moves += np.exp(alpha[:, t - 1][:, :, None] + tr + (em[:, t] + beta[:, t])[:, None, :] - z[:, None, None]).sum(0)
        return z, prob, moves

    def step(self, ids: np.ndarray, tags: np.ndarray, rate: float) -> None:
        em, (x, both, cf, cb) = self.emissions(ids, True)
        _, prob, moves = self.marginals(em)
        gold = np.eye(N_TAGS)[tags]
        d_em = (prob - gold) / len(ids)
        g = {"trans": (moves - np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])) / len(ids)}
        g["out"], g["outb"] = np.einsum("nth,ntk->hk", both, d_em), d_em.sum((0, 1))
        d_both = d_em @ self.w["out"].T
        d_x = np.zeros_like(x)
        k = self.h
        for d, cache, grad in (("f", cf, d_both[:, :, :k]), ("b", cb, d_both[:, :, k:])):
            dh, dc, da = np.zeros((len(ids), k)), np.zeros((len(ids), k)), np.zeros((*ids.shape, 4 * k))
            g["wh" + d] = np.zeros_like(self.w["wh" + d])
            for t, before_h, before_c, gate, u, tc in reversed(cache):
                dh = dh + grad[:, t]
                i, f, o = gate[:, :k], gate[:, k:2 * k], gate[:, 2 * k:]
                dc = dc + dh * o * (1 - tc * tc)
                a = np.concatenate([dc * u * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], 1)
                da[:, t] = a
                g["wh" + d] += before_h.T @ a
                dh, dc = a @ self.w["wh" + d].T, dc * f
            g["wx" + d], g["b" + d] = np.einsum("nte,nta->ea", x, da), da.sum((0, 1))
            d_x += da @ self.w["wx" + d].T
        g["emb"] = np.zeros_like(self.w["emb"])
        np.add.at(g["emb"], ids, d_x)
        self.steps += 1
        for name, grad in g.items():
            m, v = self.moments.setdefault(name, [np.zeros_like(grad), np.zeros_like(grad)])
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            self.w[name] -= rate * (m / (1 - 0.9 ** self.steps)) / (np.sqrt(v / (1 - 0.999 ** self.steps)) + 1e-8)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window and the probability of each tag."""
        em, _ = self.emissions(ids)
        _, prob, _ = self.marginals(em)
        tr = self.w["trans"] + self.barred
        score, back = em[:, 0] + self.start, np.zeros(em.shape, np.int64)
        for t in range(1, em.shape[1]):
            s = score[:, :, None] + tr
            back[:, t] = s.argmax(1)
            score = s.max(1) + em[:, t]
        tags = np.zeros(ids.shape, np.int64)
        tags[:, -1] = score.argmax(1)
        for t in range(em.shape[1] - 1, 0, -1):
            tags[:, t - 1] = back[np.arange(len(ids)), t, tags[:, t]]
        return tags, np.take_along_axis(prob, tags[:, :, None], 2)[:, :, 0]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return np.log(np.exp(x - m).sum(axis)) + np.squeeze(m, axis)


# ---- windows ----------------------------------------------------------------

def window_starts(text: str, length: int) -> list[int]:
    """Starts of windows, half overlapping, that cover all within half a window of a digit or ``@``."""
    step, out = length // 2, []
    for m in _TRIGGER.finditer(text):
        k = m.start() // step
        for s in (k - 1, k):
            if s >= 0 and (not out or s * step > out[-1]):
                out.append(s * step)
    return out


def _rewritten(span: str, kind: str, r: np.random.Generator) -> str:
    """The same datum in another form: separators, country code, grouping."""
    digits = re.sub(r"\D", "", span)
    sep = str(r.choice([" ", "-", "."]))
    if kind == "phone":
        local = digits[-10:]
        return str(r.choice([f"({local[:3]}) {local[3:6]}-{local[6:]}", sep.join((local[:3], local[3:6], local[6:])), "00" + digits[:-10] + " " + sep.join((local[:3], local[3:6], local[6:]))]))
    if kind == "card":
        return sep.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if kind == "email":
        return span.replace("@", str(r.choice([" @ ", "@"])))
    return span


def training_windows(text: str, p: PiiParams, r: np.random.Generator) -> list[tuple[str, list[Span]]]:
    out = []
    spans = base_spans(text)
    for s, e, kind in spans:
        if e - s > p.length - 8:
            continue
        for form in {text[s:e], _rewritten(text[s:e], kind, r)}:
            lead = int(r.integers(0, p.length - len(form))) if len(form) < p.length else 0
            lo = max(0, s - lead)
            if any(lo <= x < s + p.length and (x, y) != (s, e) for x, y, _ in spans):
                continue
            window = text[lo:s] + form + text[e:]
            out.append((window[:p.length], [(s - lo, s - lo + len(form), kind)]))
    for m in _TRIGGER.finditer(text):
        lo = max(0, m.start() - int(r.integers(0, p.length)))
        if r.random() < 0.2 and not any(x < lo + p.length and y > lo for x, y, _ in spans):
            out.append((text[lo:lo + p.length], []))
    return out


def train(docs: DataFrame, p: PiiParams = PiiParams()) -> Network | None:
    """Fit on windows of a bounded sample of documents, the least by a hash of doc_id."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = []
            for key, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist()):
                r = np.random.default_rng(abs(key))
                rows += [(key, n, w, [KINDS.index(k) for *_, k in s], [x for x, *_ in s], [y for _, y, _ in s]) for n, (w, s) in enumerate(training_windows(t, p, r))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int64())] * 3))], ["key", "n", "w", "kind", "s", "e"])

    data = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id").alias("key"), "text")
    ids = data.select("key").orderBy("key").limit(p.docs)
    top = ids.agg(F.max("key")).first()[0]
    if top is None:
        return None
    rows = (data.where(F.col("key") <= top).mapInArrow(cut, "key long, n long, w string, kind array<long>, s array<long>, e array<long>")
            .orderBy(F.xxhash64("w"), "key", "n").limit(p.windows).collect())
    if not any(r["kind"] for r in rows):
        return None
    ids = np.stack([encode(r["w"], p.length) for r in rows])
    tags = np.zeros(ids.shape, np.int64)
    for i, r in enumerate(rows):
        for k, s, e in zip(r["kind"], r["s"], r["e"]):
            tags[i, s:e] = 2 + 2 * k
            tags[i, s] = 1 + 2 * k
    net, r = Network(p), np.random.default_rng(p.seed)
    spans = np.flatnonzero(tags.any(1))
    for step in range(p.steps):  # half of a batch are windows with a span
        part = np.concatenate([r.choice(spans, p.batch // 2), r.integers(0, len(ids), p.batch - p.batch // 2)])
        net.step(ids[part], tags[part], 0.02 if step < p.steps * 2 // 3 else 0.004)
    net.moments = {}
    return net


def network_spans(texts: list[str], net: Network, p: PiiParams, at_once: int = 512) -> list[list[tuple[float, Span]]]:
    """(probability, span) of each text, from overlapping windows decoded one by one."""
    todo = [(i, s) for i, t in enumerate(texts) for s in window_starts(t, p.length)]
    found: list[dict[Span, float]] = [{} for _ in texts]
    for at in range(0, len(todo), at_once):
        part = todo[at:at + at_once]
        ids = np.stack([encode(texts[i][s:s + p.length], p.length) for i, s in part])
        tags, prob = net.decode(ids)
        for (i, s), tag, pr in zip(part, tags, prob):
            begin = np.flatnonzero(tag % 2 == 1)
            size = min(p.length, len(texts[i]) - s)
            for b in begin:
                e = b + 1
                while e < p.length and tag[e] == tag[b] + 1:
                    e += 1
                cut_off = b == 0 and s > 0 or e >= size and s + size < len(texts[i])
                if not cut_off and e <= size:
                    span = (int(s + b), int(s + e), KINDS[(tag[b] - 1) // 2])
                    found[i][span] = max(found[i].get(span, 0.0), float(pr[b:e].min()))
    return [[(q, x) for x, q in f.items()] for f in found]


def plausible(text: str, span: Span) -> bool:
    part, digits = text[span[0]:span[1]], sum(c.isdigit() for c in text[span[0]:span[1]])
    if span[2] == "email":
        return "@" in part and "." in part[part.index("@"):]
    if span[2] == "ip":
        return part.count(".") == 3 and digits >= 4
    if span[2] == "card":
        return 14 <= digits <= 19 and luhn(re.sub(r"\D", "", part)) and not re.search(r"[^\W\d_]", part)
    return 10 <= digits <= 15 and not re.search(r"[^\W\d_]", part)


def reconcile(base: list[Span], added: list[tuple[float, Span]], text: str, least: float) -> list[Span]:
    """Base spans, and the likeliest added ones that overlap none."""
    out = list(base)
    for q, x in sorted(added, key=lambda a: (-a[0], a[1])):
        if q >= least and plausible(text, x) and all(x[1] <= s or x[0] >= e for s, e, _ in out):
            out.append(x)
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find(docs: DataFrame, net: Network | None, p: PiiParams = PiiParams()) -> DataFrame:
    """doc_id, base counts, base_sha256, spans, n_added of each row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(net)
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(c, T.LongType()) for c in counts],
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = network_spans(texts, shared.value, p) if shared.value else [[] for _ in texts]
            every = [reconcile(x, a, t, p.least) for x, a, t in zip(base, added, texts)]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), *[pa.array([sum(s[2] == k for s in x) for x in base], pa.int64()) for k in KINDS],
                pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x in base]), pa.array([_joined(x) for x in every]),
                pa.array([len(x) - len(y) for x, y in zip(every, base)], pa.int64())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
