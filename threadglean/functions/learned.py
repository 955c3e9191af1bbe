"""A naive Bayes classifier in column expressions (X2, F11).

Words are hashed into BUCKETS by the first 16 bits of their md5, and a bucket counts once for
a text. Training is one grouped count over labelled rows. Buckets whose share differs
between the labels by more than chance (likelihood ratio LEAST_G2) get a weight, the others
none: texts have hundreds of words, and the noise of rare ones would add up. A model is a
prior and the weights in whole thousandths of a nat, so a text's score is a sum in its row that
does not depend on any order. Scoring needs no join, no shuffle and no Python worker.
"""

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import functions as F

BUCKETS = 65_536
# Likelihood ratio from which a bucket tells the labels apart; chance alone exceeds it in
# one of 100,000 buckets.
LEAST_G2 = 20.0
# Labelled rows that a model is trained on at most: those whose keys have the least md5.
MAX_LABELLED = 20_000


def _col(c):
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class NaiveBayes:
    """log P(label) / P(no label) and its share per word bucket, times 1000."""

    prior: int
    weights: tuple

    def score(self, text):
        """Thousandths of a nat in favour of the label; a null or wordless text has the prior."""
        # Folded to one literal by the optimizer.
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<long>")
        return F.aggregate(
            word_buckets(text), F.lit(self.prior).cast("long"), lambda total, bucket: total + F.get(table, bucket))

    def flags(self, text):
        """Whether the label is the likelier one; False for a null text."""
        return _col(text).isNotNull() & (self.score(text) > 0)


def word_buckets(text):
    """The distinct buckets of the words (runs of letters, in lower case) of a text."""
    text = _col(text)
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), F.lit(1))
    return F.array_distinct(F.transform(
        words, lambda w: F.conv(F.left(F.md5(w.cast("binary")), F.lit(4)), 16, 10).cast("int")))


def _g2(a, all_a, b, all_b):
    """Likelihood ratio of the shares a / all_a and b / all_b being one share (arrays)."""
    total, out = all_a + all_b, 0.0
    for got, share in ((a, a + b), (all_a - a, total - a - b)):
        for seen, size in ((got, all_a), (share - got, all_b)):
            expected = np.maximum(share * size / total, 1e-300)
            out = out + 2 * seen * np.log(np.where(seen > 0, seen / expected, 1.0))
    return out


def labelled_rows(texts, labels, key, max_rows=MAX_LABELLED):
    """The rows of `texts` that have a label, with the columns of `labels`: at most `max_rows`
    keys, those with the least md5, which are sent to all executors. Keys of several labels are
    left out, since they say nothing."""
    named = labels.dropna().groupBy(key).agg(
        *[F.min(c).alias(c) for c in labels.columns if c != key], F.count("*").alias("__n")).where("__n = 1").drop("__n")
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    chosen = named.orderBy(digest, key).limit(max_rows)
    pinned = texts.sparkSession.createDataFrame(chosen.toArrow(), chosen.schema)
    return texts.join(F.broadcast(pinned), key)


def train(rows, label, text_col):
    """A NaiveBayes from rows with a boolean `label` expression; rows with a null label are
    left out. Without rows of both kinds every text has score 0."""
    rows = rows.select(F.expr(label).alias("label"), F.col(text_col).alias("text")).dropna(subset=["label"])
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return NaiveBayes(0, (0,) * BUCKETS)
    counted = rows.select("label", F.explode(word_buckets("text")).alias("bucket")).groupBy("bucket").agg(
        F.count_if(F.col("label")).alias("yes"), F.count_if(~F.col("label")).alias("no")).toArrow()
    yes, no = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = np.asarray(counted["bucket"])
    yes[at], no[at] = np.asarray(counted["yes"]), np.asarray(counted["no"])
    all_yes, all_no = sizes[True], sizes[False]
    weights = np.zeros(BUCKETS, np.int64)
    for i in np.flatnonzero(_g2(yes, all_yes, no, all_no) >= LEAST_G2).tolist():
        shares = (2 * int(yes[i]) + 1) * (2 * all_no + 2) / ((2 * int(no[i]) + 1) * (2 * all_yes + 2))
        weights[i] = math.floor(1000 * math.log(shares))
    return NaiveBayes(math.floor(1000 * math.log(all_yes / all_no)), tuple(weights.tolist()))
