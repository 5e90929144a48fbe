"""Small inputs and plain-Python versions shared by the tests of the training-data operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def words(text):
    return WORD.findall(text or "")


def row(i, text, lang="en", source="s0"):
    return (i, text, lang, source, None if text is None else len(text))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, odd characters."""
    long = " ".join(random.Random(5).choice(["alpha", "beta", "gamma", "delta", "épsilon"]) + str(i % 977) for i in range(60_000))
    return [
        row(1, "the quick brown fox jumps over the lazy dog and runs away"),
        row(1, "the quick brown fox jumps over the lazy dog and runs away"),  # repeated row
        row(2, None),
        row(3, ""),
        row(4, " \t\n\r\x0b\x0c "),
        (None, "a text without an id or source", None, None, None),
        (None, "a text without an id or source", None, None, None),
        row(5, "日本語 text ▁ with odd \U0001f600 characters\x00 and \x1f"),
        row(6, long, None, None),
        row(7, "x"),
        row(8, "X"),
        row(9, "one two", "de", "s1"),
        row(10, "one two", "de", "s1"),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def extra(df, *names):
    """The frame with more columns, named like an operator's own."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"old {n}").alias(n) for n in names])


class Groups:
    """Union-find over ids; a group is named by its smallest id."""

    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
