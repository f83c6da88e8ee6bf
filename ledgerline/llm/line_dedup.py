"""Line dedup: exact set-similarity join of the lines of all documents.

Lines are cut at ``\\n``; a line's tokens are its distinct lower-cased words
between white space.  A line is removed if an earlier line, by (doc_id, line
number, see below for rows that share a doc_id), has a Jaccard similarity of at least ``num/den`` (0.8); the earlier
line counts whether or not it stays.  Lines without a token always stay.

DataFrame functions only:

1. Rarity: word occurrences are counted in hash buckets over all documents.  A
   word's code is a long made of the bucket's count (whole log2) and 58 bits of the
   word's hash, so sorting codes sorts by rarity; equal codes are taken as
   equal words.
2. Equal token sets meet in one row, the earliest line (partial aggregates, so
   that a line with any number of copies is no hot group).
3. Prefix filter: two sets of similarity t share one of their first
   ``n - ceil(t n) + 1`` codes, and the smaller set (or either, if as large) needs only
   its first ``n - ceil(2 t n / (1 + t)) + 1`` for it, so these are joined with all.
   Candidates also pass the length filter, the
   positional filter and a parity filter: the sets' parity words differ in at
   most as many bits as the sets in tokens.  Long sets have three 64-bit words,
   whose exclusive or is the one word of a short set.
4. First only the few earliest sets of some codes of the prefix are partners, of
   codes that are not rare, which removes nearly all of a large group of variants
   with a bounded number of candidates for each set.  Then each candidate whose
   later set is left is looked at.
5. Candidates are verified on the whole token sets.

A document's place is its doc_id (none comes last), then, among rows that share
a doc_id with different texts or have none, the text's hash ``th``.  Exact copies
of a row have one place: their lines at the same line number tie, don't remove
each other, and stay or go together.  Null text has no lines and stays null.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import small_broadcast, staged

LAST = (1 << 63) - 1
LINE = ["at", "th", "no"]  # names a line: its document's place and its number
CODE_BITS = 58  # of a word's hash in its code; five bits above hold the frequency class
JOIN_BITS = 40  # of a code that candidates are joined by; a chance meeting only costs a look at the pair


@dataclass(frozen=True)
class LineParams:
    num: int = 4                     # similarity num / den
    den: int = 5
    bucket_bits: int = 16            # rarity is counted in 2 ** bucket_bits hash buckets
    long_set: int = 96               # tokens from which a set has three parity words
    first_codes: int = 4             # prefix codes, spread over it, whose earliest sets are tried first
    first_sets: int = 8              # how many of them
    first_size: int = 11             # frequency class from which codes are tried so; rarer ones have few partners in the join
    broadcast_bytes: int = 24 << 20  # size check of the stored lists that are broadcast


BLANKS = " \t\r\x0b\x0c"


def _plain(text: Column) -> Column:
    """The text with spaces for the other white space inside lines; one-character splits are much faster than patterns."""
    return F.when(text.rlike("[\t\r\x0b\x0c]"), F.translate(text, "\t\r\x0b\x0c", "    ")).otherwise(text)


def _words(plain: Column) -> Column:
    """Lower-cased words; empty ones stand between, before and after several spaces."""
    return F.split(F.lower(plain), " ")


def _blank(line: Column) -> Column:
    return F.ltrim(line, F.lit(BLANKS)) == ""


def placed(docs: DataFrame, p: LineParams) -> DataFrame:
    """``docs`` and their place: __at (doc_id, null last), __th (hash of the text; 0 if no other text has the doc_id).

    The zeros keep the sets small in shuffles.
    """
    th = F.xxhash64("text")
    several = docs.where("doc_id is not null and text is not null").groupBy(F.col("doc_id").cast("long").alias("__at")).agg(F.min(th).alias("a"), F.max(th).alias("b"))
    several = staged(several.where("a <> b").select("__at", F.lit(True).alias("__several")), "line-several")
    rows = docs.withColumn("__at", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).join(small_broadcast(several, p.broadcast_bytes), "__at", "left")
    return rows.withColumn("__th", F.when(F.col("doc_id").isNull() | F.col("__several"), th).otherwise(F.lit(0).cast("long"))).drop("__several")


def _lines(docs: DataFrame) -> DataFrame:
    """at, th, no, line (plain) of every line of placed documents."""
    return docs.where("text is not null").select(F.col("__at").alias("at"), F.col("__th").alias("th"), F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("no", "line"))


def frequency_classes(docs: DataFrame, p: LineParams) -> Column:
    """Array literal: hash bucket -> whole log2 of its count (0 to 31), the leading bits of a code.

    Only the order of codes rests on it, no result does.
    """
    words = docs.where("text is not null").select(F.explode(_words(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")))).alias("w"))
    n = words.groupBy(F.shiftrightunsigned(F.xxhash64("w"), 64 - p.bucket_bits).alias("b")).count()
    size = {x["b"]: min(31, x["count"].bit_length() - 1) for x in n.collect()}  # at most 2 ** bucket_bits rows
    return F.split(F.lit(",".join(str(size.get(b, 0)) for b in range(2 ** p.bucket_bits))), ",").cast("array<tinyint>")


def token_codes(line: Column, classes: Column, p: LineParams) -> Column:
    """A plain line's distinct tokens as sorted codes, the rarest first."""
    def code(word: Column) -> Column:
        h = F.xxhash64(word)
        size = F.coalesce(F.get(classes, F.shiftrightunsigned(h, 64 - p.bucket_bits).cast("int")).cast("long"), F.lit(0).cast("long"))  # never null, so that longs are sorted
        return F.shiftleft(size, CODE_BITS).bitwiseOR(h.bitwiseAND((1 << CODE_BITS) - 1))

    return F.sort_array(F.array_except(F.transform(_words(line), code), F.array(code(F.lit("")))))


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("int")


def _parity(codes: Column) -> Column:
    one = F.lit(1).cast("long")
    return F.aggregate(codes, F.lit(0).cast("long"), lambda acc, c: acc.bitwiseXOR(F.call_function("shiftleft", one, c.bitwiseAND(63).cast("int"))))


def token_sets(docs: DataFrame, classes: Column, p: LineParams) -> DataFrame:
    """One row for each distinct token set: its earliest line (at, th, no), size n, parity word and prefix codes."""
    # a filter on the codes would be pushed below and make them twice
    coded = _lines(docs).where(~_blank(F.col("line"))).select("at", "th", "no", token_codes(F.col("line"), classes, p).alias("codes"))
    n = F.size("codes")
    part = lambda k: F.when(n >= p.long_set, _parity(F.filter("codes", lambda c: F.pmod(F.shiftright(c, 6), F.lit(3)) == k))).otherwise(0)
    coded = coded.withColumns({"all": _parity(F.col("codes")), "p2": part(1), "p3": part(2)})
    row = F.struct("at", "th", "no", n.alias("n"), F.col("all").bitwiseXOR(F.col("p2")).bitwiseXOR(F.col("p3")).alias("p1"), "p2", "p3",
                   F.slice("codes", 1, n - _ceil_div(n * p.num, p.den) + 1).alias("prefix"))
    return (coded.groupBy(F.xxhash64("codes").alias("d1"), F.xxhash64(F.lit(7), F.col("codes")).alias("d2"))
            .agg(F.min(row).alias("s")).select("s.*"))


def _earlier(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    out = F.lit(False)
    for c in reversed(LINE):
        out = (a(c) < b(c)) | ((a(c) == b(c)) & out)
    return out


def _size(row: Callable[[str], Column]) -> Column:
    return F.shiftright(row("meta"), 32)


def _near(a: Callable[[str], Column], b: Callable[[str], Column], p: LineParams) -> Column:
    """The filters of a pair that shares a code, by columns a(name) and b(name).  meta: size, position from 1, done."""
    na, nb = _size(a), _size(b)
    ia, ib = (F.shiftright(r("meta"), 1).bitwiseAND(0x7FFFFFFF) for r in (a, b))
    # in common: at least (na + nb) num / (num + den); apart has the parity of na + nb
    d1, d2, d3 = (a(f"p{k}").bitwiseXOR(b(f"p{k}")) for k in (1, 2, 3))
    folded = F.bit_count(d1.bitwiseXOR(d2).bitwiseXOR(d3))
    apart = F.when(F.least(na, nb) >= p.long_set, F.bit_count(d1) + F.bit_count(d2) + F.bit_count(d3)).otherwise(folded)
    return ((na * p.num <= nb * p.den) & (nb * p.num <= na * p.den)
            & ((na + nb) * p.num <= (1 + F.least(na - ia, nb - ib)) * (p.num + p.den))
            & ((na + nb) * (2 * p.num) <= (na + nb - apart) * (p.num + p.den)))


def _first_candidates(early: DataFrame, p: LineParams) -> DataFrame:
    """Distinct pairs (one of a code's first_sets earliest sets x, later y) that pass the filters."""
    order = Window.partitionBy("code").orderBy(*LINE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = F.struct(*LINE, "p1", "p2", "p3", "meta")
    firsts = early.select("*", *[F.nth_value(x, k + 1).over(order).alias(f"x{k}") for k in range(p.first_sets)])

    def found(x: str) -> Column:
        itself = F.lit(True)
        for c in LINE:
            itself &= F.col(f"{x}.{c}") == F.col(c)
        return F.when(F.col(x).isNotNull() & ~itself & _near(lambda c: F.col(f"{x}.{c}"), F.col, p), F.struct(*[f"{x}.{c}" for c in LINE]))

    pairs = firsts.select(*[F.col(c).alias("y" + c) for c in LINE], F.explode(F.array_compact(F.array(*[found(f"x{k}") for k in range(p.first_sets)]))).alias("x"))
    return pairs.select(*[F.col(f"x.{c}").alias("x" + c) for c in LINE], *["y" + c for c in LINE]).distinct()


def _candidates(short: DataFrame, long: DataFrame, p: LineParams) -> DataFrame:
    """Distinct pairs (earlier x, later y) that share a code and pass the filters, if y is not done.

    A pair's larger set is the one of ``long``; of two as large it is the later one.
    """
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    first = _earlier(a, b)
    done = F.when(first, b("meta")).otherwise(a("meta")).bitwiseAND(1)
    on = (a("code") == b("code")) & (_size(a) <= _size(b)) & _near(a, b, p) & ((_size(a) < _size(b)) | first) & (done == 0)
    x, y = ([F.when(first, u(c)).otherwise(v(c)).alias(s + c) for c in LINE] for s, u, v in (("x", a, b), ("y", b, a)))
    return short.alias("a").join(long.alias("b"), on).select(*x, *y).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, classes: Column, p: LineParams) -> DataFrame:
    """at, th, no of the later lines of the candidate pairs that are similar indeed."""
    pairs = staged(pairs, "line-pairs")
    need = pairs.select(*[F.col("x" + c).alias(c) for c in LINE]).union(pairs.select(*["y" + c for c in LINE])).distinct()
    need = small_broadcast(staged(need.groupBy("at", "th").agg(F.collect_list("no").alias("nos")), "line-need"), p.broadcast_bytes)
    by_doc = docs.where("text is not null").select(F.col("__at").alias("at"), F.col("__th").alias("th"), "text").join(need, ["at", "th"])
    codes = by_doc.select("at", "th", F.posexplode(F.split(_plain(F.col("text")), "\n")).alias("no", "line"), "nos").where(F.array_contains("nos", F.col("no")))
    codes = codes.select("at", "th", "no", token_codes(F.col("line"), classes, p).alias("codes")).distinct()  # exact copies share a place
    codes = staged(codes, "line-codes")
    x = codes.select(*[F.col(c).alias("x" + c) for c in LINE], F.col("codes").alias("xc"))
    y = codes.select(*[F.col(c).alias("y" + c) for c in LINE], F.col("codes").alias("yc"))
    shared = F.size(F.array_intersect("xc", "yc"))
    similar = shared * (p.num + p.den) >= (F.size("xc") + F.size("yc")) * p.num
    return pairs.join(x, ["x" + c for c in LINE]).join(y, ["y" + c for c in LINE]).where(similar).select(*[F.col("y" + c).alias(c) for c in LINE]).distinct()


def surviving_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """at, th, no of the lines with tokens that stay; ``docs`` are placed."""
    classes = frequency_classes(docs, p)
    sets = staged(token_sets(docs, classes, p), "line-sets")
    meta = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft((F.col("i") + 1).cast("long"), 1))
    short_code = F.col("code").bitwiseAND((1 << JOIN_BITS) - 1).alias("code")
    size, k = F.size("prefix"), F.lit(p.first_codes - 1)
    spread = F.array_distinct(F.transform(F.sequence(F.lit(0), k), lambda j: F.floor(j * (size - 1) / F.greatest(k, F.lit(1))).cast("int")))
    early = (sets.select("*", F.explode(spread).alias("i")).withColumn("code", F.get("prefix", F.col("i")))
             .where(F.shiftright("code", CODE_BITS) >= p.first_size).select(short_code, *LINE, "p1", "p2", "p3", meta.alias("meta")))
    done = staged(_verified(_first_candidates(early, p), docs, classes, p), "line-done").withColumn("done", F.lit(1).cast("long"))
    marked = sets.join(small_broadcast(done, p.broadcast_bytes), LINE, "left")
    meta = meta.bitwiseOR(F.col("done"))
    code = (marked.withColumn("done", F.coalesce("done", F.lit(0).cast("long"))).select("*", F.posexplode("prefix").alias("i", "code"))
            .select(short_code, *LINE, "p1", "p2", "p3", meta.alias("meta")))
    # a set of n and one as large or larger share one of the set's first n - ceil(2 n num / (num + den)) + 1 codes
    n, i = F.shiftright("meta", 32), F.shiftright("meta", 1).bitwiseAND(0x7FFFFFFF)
    short = code.where((i - 1) * (p.num + p.den) <= n * (p.den - p.num))
    more = staged(_verified(_candidates(short, code, p), docs, classes, p), "line-more")
    gone = small_broadcast(staged(done.select(*LINE).union(more.select(*LINE)), "line-gone"), p.broadcast_bytes)
    return sets.select(*LINE).join(gone, LINE, "left_anti")


def _with_left(docs: DataFrame, p: LineParams) -> DataFrame:
    """``docs`` and __left, the lines that stay (null for null text)."""
    docs = placed(docs, p)
    kept = staged(surviving_lines(docs, p).groupBy(F.col("at").alias("__at"), F.col("th").alias("__th")).agg(F.collect_set("no").alias("__kept")), "line-kept")
    stays = lambda x, i: _blank(x) | F.coalesce(F.array_contains("__kept", i), F.lit(False))
    return (docs.join(small_broadcast(kept, p.broadcast_bytes), ["__at", "__th"], "left")
            .withColumn("__left", F.filter(F.split("text", "\n"), stays)).drop("__at", "__th", "__kept"))


def dedup_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """doc_id, text left of removed lines, n_lines, n_removed of every row; a text may be left empty."""
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    n = F.when(F.col("text").isNull(), 0).otherwise(n).cast("long")
    left = F.when(F.col("text").isNull(), 0).otherwise(F.size("__left")).cast("long")
    return _with_left(docs.select("doc_id", "text"), p).select(
        "doc_id", F.array_join("__left", "\n").alias("text"), n.alias("n_lines"), (n - left).alias("n_removed"))


def drop_repeated_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """``docs`` without the removed lines; a document that lost lines and has no word left goes.

    Columns as given; ``n_chars``, if there, is counted anew for changed texts.
    """
    left = F.array_join("__left", "\n")
    changed = F.col("text").isNotNull() & (F.size("__left") < F.size(F.split("text", "\n")))
    empty = F.trim(F.translate(left, "\n\t\r\x0b\x0c", "     ")) == ""
    out = _with_left(docs, p).where(~(changed & empty) | F.col("text").isNull())
    cols = {"text": F.when(changed, left).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        cols["n_chars"] = F.when(changed, F.length(left)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[cols.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
