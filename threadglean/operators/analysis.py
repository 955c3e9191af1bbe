"""Staging, join with the model results, validation and processing status."""

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import comment_quality, summary_quality
from threadglean.operators import scale
from threadglean.operators.merge import merge_keyed
from threadglean.schemas import STAGING_COLUMNS


def staging(summary_table):
    """Rows still to process: a body and a flag that is true (not null)."""
    return summary_table.where(
        F.col("comment_body").isNotNull() & F.col("needs_processing")).select(*STAGING_COLUMNS)


def with_results(staged, summaries, sentiments):
    """Staging with its summary and sentiment by comment_id, nulls where missing,
    and the two quality labels. The result tables are keyed by comment_id, so
    both joins share one shuffle of the staged rows."""
    joined = staged.join(summaries.select("comment_id", "comment_summary"), "comment_id", "left")
    joined = joined.join(
        sentiments.select("comment_id", "sentiment_score", "sentiment_label"), "comment_id", "left")
    return joined.select(
        *staged.columns, "comment_summary", "sentiment_score", "sentiment_label",
        comment_quality("comment_body").alias("comment_quality"),
        summary_quality("comment_summary", "comment_body").alias("summary_quality"),
    )


def joined_analysis(staged, summaries, sentiments, run_ts=None):
    """The rows whose comment and summary are both Valid, stamped."""
    both = (F.col("comment_quality") == "Valid") & (F.col("summary_quality") == "Valid")
    clock = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return with_results(staged, summaries, sentiments).where(both).select(
        "*", clock.alias("processed_at"), F.lit(K.PROCESSED_BY).alias("processed_by"))


def attempted(staged, **skew):
    """(comment_id, post_id) of every staged row, valid or not, and `copies`: how
    often the row comes back when staging is joined to itself by comment_id.

    The count replaces the join, whose output grows with the square of the
    posts a comment_id occurs under. A null id has no partner and comes back once.
    """
    sizes = staged.where(F.col("comment_id").isNotNull()).groupBy("comment_id").agg(
        F.count("*").alias("copies"))
    counted = scale.skew_join(staged.select("comment_id", "post_id"), sizes, "comment_id",
                              "left", ["post_id", "comment_id"], **skew)
    return counted.select("comment_id", "post_id", F.coalesce("copies", F.lit(1)).alias("copies"))


def merge_status(history, staged):
    """History after a run: every attempted (comment_id, post_id), also of rows
    that failed validation. The merge keeps one row per key."""
    return merge_keyed(history, staged.select("comment_id", "post_id"),
                       ["comment_id", "post_id"], "take_new")
