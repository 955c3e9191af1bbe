"""Marks, merges, summaries and status."""

import datetime as dt

from pyspark.sql import functions as F

from threadglean.operators import analysis, merge, summary, watermark
from tests.helpers import column, rows

T0 = dt.datetime(2025, 1, 10)
HALF = dt.timedelta(seconds=0.5)
HOUR = dt.timedelta(hours=1)


def times(spark, values):
    return spark.createDataFrame([(i, "a", v) for i, v in enumerate(values)],
                                 "i int, subreddit string, created_utc timestamp")


def test_marks(spark):
    df = times(spark, [T0, T0 + HALF, None])
    assert watermark.high_water_mark(df).first().mark == T0.replace(tzinfo=dt.timezone.utc).timestamp() + 0.5
    assert watermark.high_water_mark(df.where("false")).first().mark == 0
    assert watermark.last_run_mark(df, "created_utc").first().mark == T0 + HALF
    assert watermark.last_run_mark(df.where("false"), "created_utc").first().mark is None


def test_incremental_rows(spark):
    df = times(spark, [T0, T0 + HALF, None, T0 - HOUR]).unionByName(
        spark.createDataFrame([(9, "b", T0 - HOUR), (8, None, T0)], "i int, subreddit string, created_utc timestamp"))
    mark = T0.replace(tzinfo=dt.timezone.utc).timestamp()
    assert column(watermark.rows_after(df, mark), "i") == [1]
    marks = spark.createDataFrame([("a", mark)], "subreddit string, mark double")
    assert column(watermark.new_rows_by_mark(df, marks), "i") == [1, 8, 9]
    assert column(watermark.new_rows_by_mark(df, marks.where("false")), "i") == [0, 1, 3, 8, 9]


def test_incremental_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    times(spark, [T0, T0 + HOUR]).write.partitionBy("subreddit").parquet(path)
    marks = spark.createDataFrame([("a", 1.0)], "subreddit string, mark double")
    got = watermark.new_rows_by_mark(spark.read.parquet(path), marks)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_utc" in plan and got.count() == 2


def test_time_range(spark):
    df = times(spark, [T0, T0 + HALF, T0 + HOUR, T0 + HOUR + HALF, None])
    assert column(watermark.time_range(df, T0, T0 + HOUR), "i") == [1, 2]
    assert column(watermark.time_range(df, None, T0 + HOUR), "i") == [0, 1, 2]


def test_advance_marks(spark):
    marks = spark.createDataFrame(
        [("a", 100, T0), ("b", 2_000_000_000_000, T0)],
        "subreddit string, last_processed_utc long, last_run_timestamp timestamp")
    accepted = spark.createDataFrame([("a", T0), ("a", T0 + HOUR), ("b", T0), ("c", T0)],
                                     "subreddit string, created_utc timestamp")
    got = {r.subreddit: (r.last_processed_utc, r.last_run_timestamp)
           for r in watermark.advance_marks(marks, accepted, T0 + HOUR).collect()}
    end = int((T0 + HOUR).replace(tzinfo=dt.timezone.utc).timestamp())
    assert got == {"a": (end, T0 + HOUR), "b": (2_000_000_000_000, T0), "c": (end - 3600, T0 + HOUR)}


KV = "k string, v int, w int"


def test_merge_keyed(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], KV)
    new = spark.createDataFrame([("b", 20, 20), ("c", 30, 30), ("c", 31, 31), (None, 4, 4)], KV)
    first, last = [F.asc("v")], [F.desc("v")]
    assert rows(merge.insert_ignore(old, new, ["k"], first)) == [("a", 1, 1), ("b", 2, 2), ("c", 30, 30)]
    assert rows(merge.rows_to_insert(old, new, ["k"], first)) == [("c", 30, 30)]
    assert rows(merge.merge_keyed(old, new, ["k"], "take_new", order=last)) == [
        ("a", 1, 1), ("b", 20, 20), ("c", 31, 31)]
    assert rows(merge.merge_keyed(old, new, ["k"], "take_new", order=last, update_cols=["v"])) == [
        ("a", 1, 1), ("b", 20, 2), ("c", 31, 31)]
    once = merge.merge_keyed(old, new, ["k"], "take_new", order=last)
    assert rows(merge.merge_keyed(once, new, ["k"], "take_new", order=last)) == rows(once)


def test_flag_processed(spark):
    table = spark.createDataFrame(
        [("p1", "c1", True), ("p2", "c1", True), ("p3", "c2", True), ("p4", "c3", None), ("p5", "c4", None),
         ("p6", "c2", False), ("p7", None, True)],
        "post_id string, comment_id string, needs_processing boolean")
    history = spark.createDataFrame([("c1", "p1"), ("c1", "p9"), ("c3", "x"), (None, "y")],
                                    "comment_id string, post_id string")
    want = {"p1": False, "p2": False, "p3": True, "p4": False, "p5": None, "p6": False, "p7": True}
    assert dict(merge.flag_processed(table, history).select("post_id", "needs_processing").collect()) == want
    salted = merge.flag_processed(table, history, rows_per_task=1, small_limit=0)
    assert dict(salted.select("post_id", "needs_processing").collect()) == want


def make(spark):
    posts = spark.createDataFrame(
        [("p1", "a", "t1", "x", "u1", 5, T0), ("p2", "a", "t2", "x", "u2", 7, T0)],
        "post_id string, subreddit string, title string, author string, url string, score int, created_utc timestamp")
    comments = spark.createDataFrame(
        [("c1", "p1", "one", T0), ("c2", "p1", None, T0), ("c3", "gone", "x", T0), (None, "p1", "y", T0),
         ("c4", "p2", "two", T0 + HOUR), ("c1", "p2", "again", T0)],
        "comment_id string, post_id string, body string, created_utc timestamp")
    return posts, comments


def test_summary_rows(spark):
    posts, comments = make(spark)
    got = summary.posts_with_comments(posts, comments, T0)
    assert rows(got.select("post_id", "comment_id", "post_score", "comment_body")) == [
        ("p1", "c1", 5, "one"), ("p2", "c1", 7, "again"), ("p2", "c4", 7, "two")]
    salted = summary.posts_with_comments(posts, comments, T0, rows_per_task=1, small_limit=0)
    assert rows(salted) == rows(got)
    stored = got.where("post_id = 'p1'")
    fresh = summary.unseen(got, stored)
    assert rows(fresh.select("post_id", "comment_id")) == [("p2", "c1"), ("p2", "c4")]
    nulls = got.withColumn("comment_id", F.lit(None).cast("string"))
    assert summary.unseen(nulls, nulls).count() == 3
    last = spark.range(4).select("id")
    numbered = summary.with_defaults(fresh, last, partitions=3, small_limit=0)
    assert rows(numbered.select("id", "comment_id", "needs_processing")) == [(4, "c1", True), (5, "c4", True)]
    assert summary.with_defaults(fresh, last.where("false")).agg(F.min("id")).first()[0] == 1
    totals = dict(summary.counts_by_community(got).collect())
    assert totals == {"a": 3, None: 3}


def test_run_window_modes(spark):
    posts, comments = make(spark)
    late = posts.withColumn("created_utc", F.lit(T0 - HOUR))
    p, _ = summary.in_run_window(late, comments, T0, T0 + HOUR)
    assert p.count() == 0  # an older event time than the last run is never picked up
    p, c = summary.in_run_window(late, comments, (T0 - 2 * HOUR, T0), T0 + HOUR, "event_time")
    assert (p.count(), c.count()) == (2, 1)


def test_analysis(spark):
    staged = spark.createDataFrame(
        [("p1", "c1", "body"), ("p1", "c2", "b"), ("p1", "c3", "body"), ("p1", "c4", "body"), ("p2", "c1", "body")],
        "post_id string, comment_id string, comment_body string")
    summaries = spark.createDataFrame([("c1", "ok"), ("c2", "o"), ("c4", "longer")],
                                      "comment_id string, comment_summary string")
    sentiments = spark.createDataFrame([("c2", 0.5, "Neutral")],
                                       "comment_id string, sentiment_score double, sentiment_label string")
    labels = {(r.post_id, r.comment_id): (r.comment_quality, r.summary_quality)
              for r in analysis.with_results(staged, summaries, sentiments).collect()}
    assert labels == {("p1", "c1"): ("Valid", "Valid"), ("p2", "c1"): ("Valid", "Valid"),
                      ("p1", "c2"): ("Too short", "Valid"), ("p1", "c3"): ("Valid", "Missing"),
                      ("p1", "c4"): ("Valid", "Invalid")}
    got = analysis.joined_analysis(staged, summaries, sentiments, T0)
    assert rows(got.select("post_id", "sentiment_label", "processed_by", "processed_at")) == [
        ("p1", None, "dbt", T0), ("p2", None, "dbt", T0)]
    copies = {(r.comment_id, r.post_id): r.copies for r in analysis.attempted(staged).collect()}
    assert copies[("c1", "p1")] == 2 and copies[("c2", "p1")] == 1
    history = analysis.merge_status(staged.where("false").select("comment_id", "post_id"), staged)
    assert rows(analysis.merge_status(history, staged)) == rows(history)
    assert history.count() == 5


def test_staging(spark):
    df = spark.createDataFrame(
        [(1, "x", True), (2, None, True), (3, "x", False), (4, "x", None)],
        "id long, comment_body string, needs_processing boolean")
    for name in ("subreddit", "post_id", "post_url", "comment_id", "summary_date", "processed_date",
                 "post_content", "post_score"):
        df = df.withColumn(name, F.lit("z"))
    assert column(analysis.staging(df), "id") == [1]
