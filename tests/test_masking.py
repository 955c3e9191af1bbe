"""Masking by a lexicon table against one pattern of the whole lexicon."""

import random

import pytest
from pyspark.sql import functions as F

from threadglean.functions import text as X
from threadglean.operators import masking

WORDS = ["bad", "BADLY", "worse", "Été", "a-hole", "a hole", "@ss", "ss@", "frank", "very bad thing", "very bad", "x",
         "c++", r"q\E.q", "naïve", "the", "漢字", "one two three four five six seven eight nine", "b_d", "", None, "$$"]


def texts(n=300):
    rng = random.Random(7)
    pieces = ["bad", "Bad", "badly", "bad!", "A-Hole", "a hole", "x@ss", "xss@y", "frank", "very", "thing", "été", "Été",
              "c++d", "c++ d", r"q\E.q", "naïve", "NAÏVE", "NAïVE", "the f.u.c.k", "wtf", "bull crap", "漢字", "漢字x", "a$$b",
              "one two three four five six seven eight nine", "b_d", "\n", "  ", "free", "fuuuck", "x", "éx"]
    out = ["".join(rng.choice(pieces) + rng.choice([" ", "", " ", ",", "-"]) for _ in range(rng.randrange(12)))
           for _ in range(n)]
    return out + ["", None, "bad " * 5_000, "bad", "bad", "bad"]


def both(spark, lexicon, rows, **options):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(rows)], "n int, body string, word string")
    table = spark.createDataFrame([(w,) for w in lexicon], "term string")
    got = masking.mask_by_lookup(df, "body", table, "term", **options)
    assert got.columns == df.columns
    pattern = X.mask_pattern([w for w in lexicon if w])
    want = df.withColumn("body", X.mask_words("body", pattern))
    return sorted(map(tuple, got.collect()), key=repr), sorted(map(tuple, want.collect()), key=repr)


@pytest.mark.parametrize("lexicon", [WORDS, ["bad"], [], ["the", "f"], ["very bad", "$$"]])
def test_lookup_equals_one_pattern(spark, lexicon):
    got, want = both(spark, lexicon, texts())
    assert got == want


def test_lookup_by_shuffle_equals_one_pattern(spark):
    spark.conf.set("threadglean.smallInputBytes", "0")
    spark.conf.set("threadglean.hotRowsPerTask", "3")
    try:
        got, want = both(spark, WORDS, texts(80), pinned=0)
    finally:
        spark.conf.unset("threadglean.smallInputBytes")
        spark.conf.unset("threadglean.hotRowsPerTask")
    assert got == want


def test_a_million_words(spark):
    words = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    df = spark.createDataFrame([("w0 W999999, w1000000 x w77!",), ("none here",), (None,)], "body string")
    got = [r.body for r in masking.mask_by_lookup(df, "body", words).collect()]
    assert sorted(got, key=str) == sorted(["*** ***, w1000000 x ***!", "none here", None], key=str)
