import datetime as dt
import json

from pyspark.sql import functions as F

from threadglean.functions.text import mask_pattern
from threadglean.operators import ingest
from tests.helpers import column, rows

POST = "post_id string, subreddit string, title string, author string, url string, score int, " \
       "created_utc timestamp, comments string"


def raw(spark, entries):
    full = [{"post_id": f"p{i}", "subreddit": "openai", "title": "t", "author": "a", "url": "u",
             "score": 1, "created_utc": dt.datetime(2025, 1, 1), "comments": "[]", **e}
            for i, e in enumerate(entries)]
    names = [f.split()[0] for f in POST.split(", ")]
    return spark.createDataFrame([tuple(e[n] for n in names) for e in full], POST)


def test_valid_posts(spark):
    values = [None, "", "[deleted]", " ", "None", "x"]
    df = raw(spark, [{"title": v} for v in values] + [{"author": v} for v in values])
    assert column(ingest.valid_posts(df), "post_id") == ["p10", "p11", "p3", "p4", "p5", "p9"]


def test_clean_posts(spark):
    df = raw(spark, [{"post_id": "a", "title": "wtf", "score": 1}, {"post_id": "a", "title": "wtf", "score": 2},
                     {"post_id": "b", "title": None}])
    got = ingest.clean_posts(df, mask_pattern(), [F.asc("score")])
    assert "comments" not in got.columns
    assert [(r.post_id, r.title, r.score) for r in got.collect()] == [("a", "***", 1)]
    assert ingest.clean_posts(df, mask_pattern()).count() == 1


def test_parse_comments(spark):
    entry = {"body": "line\nnext", "author": "x", "comment_id": "c1", "created_utc": 1736380800.5}
    texts = [json.dumps([entry]), None, "", "not json", "[]", '[{"comment_id": "c2"}]',
             '[{"comment_id": "c3", "body": 5}]', '[{"comment_id":\n"c4"}]']
    df = raw(spark, [{"comments": t} for t in texts])
    got = {r.comment_id: r for r in ingest.parse_comments(df).collect()}
    assert sorted(got) == ["c1", "c2", "c3", "c4"]
    assert got["c1"].body == "line\nnext" and got["c1"].author == "x"
    assert got["c1"].created_utc == dt.datetime(2025, 1, 9, 0, 0, 0, 500000)
    assert got["c2"].body is None and got["c2"].created_utc is None
    assert got["c3"].body == "5"


def test_clean_comments(spark):
    def entry(key, body):
        return {"comment_id": key, "body": body, "author": "a", "created_utc": 1.0}
    df = raw(spark, [{"comments": json.dumps([entry("c1", "wtf"), entry(None, "x"), entry(None, "x")])},
                     {"comments": json.dumps([entry("c1", "wtf")])}])
    got = ingest.clean_comments(df, mask_pattern(), "subreddit", order=[F.asc("post_id")])
    assert rows(got.select("comment_id", "post_id", "body")) == [("c1", "p0", "***"), (None, "p0", "x")]


def test_epoch_without_number(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.5,)], "created_utc double").select(
        F.lit("p").alias("post_id"), F.lit("s").alias("subreddit"), F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("author"), F.lit("u").alias("url"), F.lit(1).alias("score"),
        "created_utc", F.lit(None).cast("array<struct<body:string>>").alias("comments"))
    got = ingest.to_raw_posts(df).collect()
    assert [r.created_utc for r in got] == [None, None, dt.datetime(1970, 1, 1, 0, 0, 1, 500000)]
    assert {(r.title, r.author, r.comments) for r in got} == {("None", "None", "[]")}


def test_caps_come_before_skips(spark):
    listing = spark.createDataFrame(
        [("openai", i, f"p{i:02}", float(i)) for i in range(1, 22)] + [("other", 1, "q", 1.0)],
        "subreddit string, position long, post_id string, created_utc double")
    marks = spark.createDataFrame([("openai", 3.0)], "subreddit string, mark double")
    got = column(ingest.capped_listing(listing, marks), "post_id")
    assert got == [f"p{i:02}" for i in range(4, 21)] + ["q"]
    comments = [(None, 99.0)] + [(f"b{i}", 1.0 if i == 3 else 50.0) for i in range(1, 13)]
    df = spark.createDataFrame([(comments,)], "comments array<struct<body:string,created_utc:double>>")
    kept = df.select(ingest.capped_comments("comments", F.lit(10.0))).first()[0]
    assert [c.body for c in kept] == ["b1", "b2", "b4", "b5", "b6", "b7", "b8", "b9", "b10"]


def test_guard(spark):
    posts = spark.createDataFrame([("p1", "a"), ("p2", "a")], "post_id string, subreddit string")
    comments = spark.createDataFrame(
        [("c1", "p9", "a"), ("c2", "p8", "b"), ("c3", "p1", None)],
        "comment_id string, post_id string, subreddit string")
    assert column(ingest.comments_with_new_posts(comments, posts), "comment_id") == ["c1"]
    assert column(ingest.allowed_communities(posts.withColumn("subreddit", F.lit("openai"))), "post_id") == ["p1", "p2"]
    assert ingest.allowed_communities(posts).count() == 0


def test_union_of_communities(spark):
    a, b = spark.range(2), spark.range(1)
    assert rows(ingest.union_communities({"x": a, "y": b}).select("subreddit", "id")) == [
        ("x", 0), ("x", 1), ("y", 0)]
