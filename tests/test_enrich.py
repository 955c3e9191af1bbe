import pandas as pd
from pyspark.sql import functions as F, types as T

from threadglean import constants as K
from threadglean.functions import emotion as E
from threadglean.operators import enrich
from tests.helpers import rows

STAGED = "comment_id string, comment_body string"


def test_sentiment_of(spark):
    labels = [*K.EMOTIONS, "JOY", "unknown", None]
    df = spark.createDataFrame([(x,) for x in labels], "e string")
    got = dict(df.select("e", E.sentiment_of(F.col("e"))).collect())
    assert got == {x: K.EMOTION_SENTIMENT.get((x or "").lower(), "Neutral") for x in labels}
    assert (got["amusement"], got["desire"], got["JOY"]) == ("Neutral", "Neutral", "Positive")
    counts = pd.Series(K.EMOTION_SENTIMENT.values()).value_counts().to_dict()
    assert counts == {"Negative": 11, "Positive": 10, "Neutral": 5}
    names = dict(df.select("e", E.emotion_display_name(F.col("e"))).collect())
    assert names["joy"] == "Joy" and names["unknown"] is None


def test_default_classifier(spark):
    df = spark.createDataFrame(
        [("1", "thanks, great"), ("2", "happy HAPPY sad"), ("3", "angry and sad"), ("4", "nothing here"),
         ("5", " \n"), ("6", None), ("7", "happy. " + "x" * 600 + " sad sad")], STAGED)
    got = {r.comment_id: (r.sentiment_label, r.sentiment_score, r.emotion) for r in enrich.classify(df).collect()}
    assert got["1"] == ("Positive", 1.0, "gratitude")
    assert got["2"] == ("Positive", 2 / 3, "joy")
    assert got["3"] == ("Negative", 0.5, "anger")
    assert got["4"] == ("Neutral", 0.0, "neutral")
    assert got["5"] == got["6"] == ("Neutral", 0.0, "No content")
    assert got["7"] == ("Positive", 1.0, "joy")


def load_shouter():
    def model(texts):
        if texts.str.contains("bad").any():
            raise ValueError("bad text")
        return pd.DataFrame({"comment_summary": texts.str.upper(), "label": "joy", "score": 0.9})
    return model


def test_summary_model_hook(spark):
    long = "word " * 60
    df = spark.createDataFrame([("1", "short"), ("2", long), ("3", long + "bad"), ("4", None)], STAGED)
    got = {r.comment_id: (r.comment_summary, r.error) for r in enrich.summarize(df.coalesce(1), load_shouter, "s").collect()}
    assert got == {"1": ("short", None), "2": (long.upper(), None), "3": ("", "bad text"), "4": ("", None)}


def test_classifier_hook(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "bad"), ("3", "")], STAGED)
    got = {r.comment_id: r[1:] for r in enrich.classify(df.coalesce(1), load_shouter, "c").collect()}
    assert got["1"] == (0.9, "Positive", "joy", None)
    assert got["2"] == (0.0, "Neutral", "Error in analysis", "bad text")
    assert got["3"] == (0.0, "Neutral", "No content", None)


def test_model_row_count_is_checked(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "y")], STAGED).coalesce(1)
    got = enrich.apply_model(df, "comment_body", lambda: lambda t: pd.DataFrame({"n": [1, 2, 3]}),
                             {"n": T.IntegerType()}, "three")
    assert all("3 rows" in r.error for r in got.collect())


def test_upserts(spark):
    stored = spark.createDataFrame([("1", "a"), ("2", "b")], "comment_id string, comment_summary string")
    batch = spark.createDataFrame([("2", "new", None), ("3", "c", None), (None, "d", None)],
                                  "comment_id string, comment_summary string, error string")
    assert rows(enrich.upsert_summaries(stored, batch, [F.asc("comment_summary")])) == [("1", "a"), ("2", "new"), ("3", "c")]
    ordered = batch.withColumn("at", F.lit(1)).unionByName(
        spark.createDataFrame([("3", "later", None, 2)], "comment_id string, comment_summary string, error string, at int"))
    assert rows(enrich.upsert_summaries(stored, ordered, [F.desc("at")]))[-1] == ("3", "later")
    scores = spark.createDataFrame([("1", 0.1, "Neutral")], "comment_id string, sentiment_score double, sentiment_label string")
    newer = scores.withColumn("sentiment_score", F.lit(0.9))
    assert rows(enrich.upsert_sentiments(scores, newer, [F.desc("sentiment_score")])) == [("1", 0.9, "Neutral")]


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    """More tasks than workers; each load leaves a line with its process."""
    seen = str(tmp_path / "loads")

    def load():
        import os
        import uuid

        os.makedirs(seen, exist_ok=True)
        with open(os.path.join(seen, f"{os.getpid()}-{uuid.uuid4().hex}"), "w"):
            pass
        return lambda texts: pd.DataFrame({"n": texts.str.len()})

    rows = spark.range(4000).selectExpr("id", "concat('text ', id) AS text").repartition(40)
    for name, times in (("counted", 1), ("counted", 1), ("other", 2)):
        scored = enrich.apply_model(rows, "text", load, {"n": T.LongType()}, name)
        assert scored.where("n = length(text)").count() == 4000
        workers = [f.split("-")[0] for f in __import__("os").listdir(seen)]
        assert max(workers.count(w) for w in workers) <= times
