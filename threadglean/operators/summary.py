"""Daily summary rows: comments joined to their posts, only what is not stored."""

from pyspark.sql import functions as F

from threadglean.operators import scale
from threadglean.operators.watermark import time_range


def posts_with_comments(posts, comments, run_ts, **skew):
    """One row per comment of a known post, with the required fields present.

    A comment without its post would lack post_id and be dropped, so this is an
    inner join. Comments may pile up on one post, hence the skew-safe join.
    """
    comments = comments.where(F.col("body").isNotNull() & F.col("comment_id").isNotNull()).select(
        "post_id", "comment_id", "body", F.col("created_utc").alias("__commented"))
    posts = posts.where(F.col("post_id").isNotNull()).select(
        "post_id", "subreddit", "score", "url", "title")
    joined = scale.skew_join(comments, posts, "post_id", "inner", "comment_id", **skew)
    return joined.select(
        "subreddit",
        "post_id",
        F.col("score").alias("post_score"),
        F.col("url").alias("post_url"),
        "comment_id",
        F.to_date("__commented").alias("summary_date"),
        F.lit(run_ts).cast("timestamp").alias("processed_date"),
        F.col("title").alias("post_content"),
        F.col("body").alias("comment_body"),
    )


def unseen(rows, stored):
    """Rows whose (post_id, comment_id) is not stored; null keys never match."""
    keys = ["post_id", "comment_id"]
    return rows.join(stored.select(*keys), keys, "left_anti").select(*rows.columns)


def with_defaults(rows, stored, **rank):
    """New rows as they are stored: an ascending id after the largest stored one,
    needs_processing true."""
    numbered = scale.number_rows(
        rows, [F.asc("post_id"), F.asc("comment_id")], "__no", **rank)
    last = stored.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return numbered.select(
        (F.col("__no") + last).cast("long").alias("id"), *rows.columns,
        F.lit(True).alias("needs_processing"))


def in_run_window(posts, comments, last_run, run_ts, mode="faithful"):
    """Posts and comments of this run: event time in (low, run_ts].

    mode="faithful": `last_run` is the largest processing time over all
    communities, so a post that arrives late with an older event time is never
    picked up. mode="event_time": `last_run` is a pair (posts, comments) of the
    largest event times summarised so far.
    """
    if mode == "faithful":
        low_posts = low_comments = last_run
    elif mode == "event_time":
        low_posts, low_comments = last_run
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return time_range(posts, low_posts, run_ts), time_range(comments, low_comments, run_ts)


def counts_by_community(rows):
    """Rows per community and in total (subreddit null)."""
    return rows.rollup("subreddit").agg(F.count("*").alias("n_rows"))
