"""Model stages: built-in rules as column expressions, real models by a batch hook."""

import hashlib

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from threadglean.functions.emotion import sentiment_of, with_sentiment
from threadglean.functions.text import (
    has_more_words, is_blank, summarize_text, truncate_sentences)
from threadglean.operators import scale
from threadglean.operators.merge import merge_keyed

# Models already loaded in this Python worker. Tasks reach it through `_loaded`, which
# travels by name, so all tasks of a worker share it.
_LOADED = {}


def _loaded(key, load):
    if key not in _LOADED:
        _LOADED[key] = load()
    return _LOADED[key]


def model_input(staged):
    """Only the two columns a model stage uses."""
    return scale.spread_small(staged.select("comment_id", "comment_body"))


def apply_model(df, text_col, load, outputs, name, batch_rows=512):
    """Add a batch model's columns, and `error` for rows it failed on.

    `load()` returns a function from a pandas Series of texts to a DataFrame with
    the `outputs` columns (name -> Spark type), one row per text; it is called
    once per Python worker for a `name` and a loader of this content. A batch that fails is halved until the rows that
    fail are alone, so a bad row costs only itself.
    """
    schema = T.StructType(
        list(df.schema.fields) + [T.StructField(c, t, True) for c, t in outputs.items()]
        + [T.StructField("error", T.StringType(), True)])
    columns = list(outputs)
    key = (name, hashlib.sha256(cloudpickle.dumps(load)).hexdigest())

    def scored(model, texts):
        """Result frames in row order."""
        try:
            result = model(texts)
            if len(result) != len(texts):
                raise ValueError(f"model gave {len(result)} rows for {len(texts)} texts")
            return [result[columns].set_axis(texts.index).assign(error=None)]
        except Exception as failure:  # the row is reported, the others go on
            if len(texts) == 1:
                return [pd.DataFrame({**{c: [None] for c in columns}, "error": [str(failure)]},
                                     index=texts.index)]
            half = len(texts) // 2
            return scored(model, texts.iloc[:half]) + scored(model, texts.iloc[half:])

    def batches(frames):
        model = _loaded(key, load)
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                rows = frame.iloc[start:start + batch_rows]
                parts = [p.astype(object) for p in scored(model, rows[text_col])]
                yield pd.concat([rows, pd.concat(parts)], axis=1)

    return df.mapInPandas(batches, schema)


def summarize(staged, load=None, name="summarizer"):
    """comment_id, comment_summary, error. With `load`, only texts over the word
    limit go to the model; a failure gives '' and is rejected later as Missing."""
    rows = model_input(staged)
    if load is None:
        return rows.select("comment_id", summarize_text("comment_body").alias("comment_summary"),
                           F.lit(None).cast("string").alias("error"))
    is_long = F.coalesce(has_more_words("comment_body"), F.lit(False))
    short = rows.where(~is_long).select(
        "comment_id", F.coalesce("comment_body", F.lit("")).alias("comment_summary"),
        F.lit(None).cast("string").alias("error"))
    scored = apply_model(rows.where(is_long), "comment_body", load,
                         {"comment_summary": T.StringType()}, name)
    return short.unionByName(scored.select(
        "comment_id", F.coalesce("comment_summary", F.lit("")).alias("comment_summary"), "error"))


def classify(staged, load=None, name="classifier", cues=None):
    """comment_id, sentiment_score, sentiment_label, emotion, error.

    With `load`, the model gives columns `label` and `score` for the truncated
    text; blank text and failures are (Neutral, 0.0).
    """
    rows = model_input(staged)
    no_error = F.lit(None).cast("string").alias("error")
    columns = ["comment_id", "sentiment_score", "sentiment_label", "emotion", "error"]
    if load is None:
        return with_sentiment(rows, "comment_body", cues).select(*columns[:-1], no_error)
    blank = rows.where(is_blank("comment_body")).select(
        "comment_id", F.lit(0.0).alias("sentiment_score"),
        F.lit("Neutral").alias("sentiment_label"), F.lit("No content").alias("emotion"), no_error)
    texts = rows.where(~is_blank("comment_body")).select(
        "comment_id", truncate_sentences("comment_body").alias("text"))
    scored = apply_model(texts, "text", load,
                         {"label": T.StringType(), "score": T.DoubleType()}, name)
    failed = F.col("error").isNotNull()
    return blank.unionByName(scored.select(
        "comment_id",
        F.when(failed, 0.0).otherwise(F.col("score")).alias("sentiment_score"),
        F.when(failed, "Neutral").otherwise(sentiment_of(F.col("label"))).alias("sentiment_label"),
        F.when(failed, "Error in analysis").otherwise(F.col("label")).alias("emotion"),
        "error",
    )).select(*columns)


def upsert_summaries(stored, summaries, order):
    """A later summary replaces the stored one of its comment_id; `order` says which one of a
    batch is taken."""
    return merge_keyed(stored, summaries.select(*stored.columns, *_order_columns(summaries, stored)),
                       ["comment_id"], "take_new", order=order)


def upsert_sentiments(stored, sentiments, order):
    """A later score and label replace the stored ones of their comment_id."""
    return merge_keyed(stored, sentiments.select(*stored.columns, *_order_columns(sentiments, stored)),
                       ["comment_id"], "take_new", order=order)


def _order_columns(new, stored):
    """The batch columns that only an order uses."""
    return [c for c in new.columns if c not in stored.columns]
