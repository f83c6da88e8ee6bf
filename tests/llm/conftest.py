import random

import pytest
from llm_rows import EXTRA, words
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang): nulls, empty and long texts, copies, repeated rows, other scripts."""
    r = random.Random(3)
    base = [words(r, 60) for _ in range(6)]
    out = [(i, t, "x") for i, t in enumerate(base)]
    out += [(10, base[0], "x"), (11, base[1] + " tail word", "x"), (12, None, "x"), (13, "", None), (14, " \n\t\n ", "x"), (15, "!!! 123 ...", "x"),
            (16, "日本語 テキスト\nстрока " + base[2], None), (17, "a", "x"), (18, words(r, 20_000), "x"), (2, base[2], "x"),
            (None, base[3], "x"), (None, "only here " + base[4], "x"), (19, "\x00\x01" + base[5], "x")]
    return out


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              *[T.StructField(c, T.StringType()) for c in EXTRA]]
    return spark.createDataFrame([(*row, *(f"{c}!" for c in EXTRA)) for row in odd_rows], T.StructType(fields)).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
