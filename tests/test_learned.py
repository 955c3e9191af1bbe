"""The naive Bayes classifier against a plain version, and on held-out documents."""

import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from threadglean.functions import learned

SF_DIR = "/root/testdata/sf0.1"


def buckets(text):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    return {int(hashlib.md5(w.encode()).hexdigest()[:4], 16) for w in words}


def ratio(a, all_a, b, all_b):
    total = all_a + all_b
    cells = [(a, a + b, all_a), (b, a + b, all_b), (all_a - a, total - a - b, all_a), (all_b - b, total - a - b, all_b)]
    return sum(2 * n * math.log(n * total / (row * column)) for n, row, column in cells if n)


def plain_model(rows):
    a, b = sum(x is True for x, _ in rows), sum(x is False for x, _ in rows)
    yes = Counter(k for label, t in rows if label for k in buckets(t))
    no = Counter(k for label, t in rows if label is False for k in buckets(t))
    weights = [0] * learned.BUCKETS
    for k in yes | no:
        if ratio(yes[k], a, no[k], b) >= learned.LEAST_G2:
            weights[k] = math.floor(1000 * math.log((2 * yes[k] + 1) * (2 * b + 2) / ((2 * no[k] + 1) * (2 * a + 2))))
    return math.floor(1000 * math.log(a / b)), weights


def test_model_and_scores_equal_a_plain_version(spark):
    rng = random.Random(5)
    words = ["bad", "Worse", "good", "naïve", "漢字", "x1y", "the", "été"]
    rows = []
    for _ in range(160):
        label = rng.choice([True, False, None])
        own = words if label is None else words[:2] + words[5:] if label else words[2:]
        rows.append((label, " ".join(rng.choice(own) for _ in range(rng.randrange(12)))))
    rows += [(True, None), (False, "")]
    df = spark.createDataFrame(rows, "toxic boolean, body string")
    model = learned.train(df, "toxic", "body")
    prior, weights = plain_model(rows)
    assert (model.prior, list(model.weights)) == (prior, weights) and sum(w != 0 for w in weights) >= 3
    got = df.select("body", model.score("body").alias("score"), model.flags("body").alias("flag")).collect()
    for r in got:
        score = prior + sum(weights[b] for b in buckets(r.body))
        assert r.score == score and r.flag == (r.body is not None and score > 0)


def test_one_kind_of_rows_says_nothing(spark):
    df = spark.createDataFrame([(True, "a b"), (None, "c")], "label boolean, text string")
    model = learned.train(df, "label", "text")
    assert model.prior == 0 and set(model.weights) == {0}
    assert [r[0] for r in df.select(model.flags("text")).collect()] == [False, False]


def test_labelled_rows_are_bounded_and_clear(spark):
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(30)] + [(3, "again")], "k long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(5, 1), (None, 1), (25, None)], "k long, toxic int")
    got = learned.labelled_rows(texts, labels, "k", max_rows=7).collect()
    order = sorted((i for i in range(20) if i != 5), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    assert {r.k for r in got} == set(order[:7]) and all(r.toxic == r.k % 2 for r in got)
    assert len(got) == 7 + (3 in order[:7])


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "toxic")
    model = learned.train(learned.labelled_rows(docs, labels.where("doc_id % 2 = 0"), "doc_id"), "toxic = 1", "text")
    told = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("toxic").agg(
        F.avg(model.flags("text").cast("int")).alias("flagged"))
    share = {r.toxic: r.flagged for r in told.collect()}
    assert share[1] > 0.85 and share[0] < 0.08
