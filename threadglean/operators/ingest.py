"""From listing entries to raw posts, and from raw posts to clean posts and comments."""

from functools import reduce

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import mask_words, strip_control_chars
from threadglean.operators import scale
from threadglean.schemas import COMMENTS_JSON


def allowed_communities(df, communities=tuple(K.COMMUNITIES)):
    return df.where(F.col("subreddit").isin(list(communities)))


def union_communities(frames):
    """Separate tables of one shape, community -> frame, as one table."""
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.withColumn("subreddit", F.lit(name)) for name, df in frames.items()])


def capped_listing(listing, marks, limit=K.POSTS_PER_COMMUNITY, created="created_utc", by=()):
    """The first `limit` listed posts of each community, then without those at or
    below the community's mark: the cap comes before the skip. No limit: None.

    `listing` has subreddit, position, post_id and `created` (epoch seconds);
    `marks` has subreddit and mark. With `by`, columns that tell several listings
    apart, the cap holds for each of them and all are held against the same marks.
    """
    top = listing if limit is None else scale.top_per_group(
        listing, [*by, "subreddit"], [F.asc("position"), F.asc("post_id")], limit, "__listed").drop("__listed")
    return (
        scale.lookup_join(top, marks.select("subreddit", "mark"), "subreddit")
        .where(F.col(created) > F.coalesce("mark", F.lit(0.0)))
    )


def capped_comments(comments, mark, limit=K.COMMENTS_PER_POST):
    """The first `limit` (None: all) loaded comments of a post that are newer than `mark`.

    Placeholders for hidden comments (null body) are dropped, then the slice is
    taken, then the mark is applied.
    """
    loaded = F.filter(F.col(comments), lambda c: c["body"].isNotNull())
    first = loaded if limit is None else F.slice(loaded, 1, limit)
    return F.filter(first, lambda c: c["created_utc"] > mark)


def to_raw_posts(entries):
    """Listing entries as raw rows: UTC timestamp, comments as JSON text, a
    missing author as the text None."""
    return entries.select(
        "post_id", "subreddit",
        F.coalesce("title", F.lit("None")).alias("title"),
        F.coalesce("author", F.lit("None")).alias("author"),
        F.coalesce("url", F.lit("None")).alias("url"),
        F.col("score").cast("int").alias("score"),
        F.expr("try_cast(created_utc AS timestamp)").alias("created_utc"),
        F.coalesce(F.to_json("comments"), F.lit("[]")).alias("comments"),
    )


def is_valid_post():
    tests = None
    for name in ("title", "author"):
        c = F.col(name)
        test = c.isNotNull() & (c != "") & (c != K.DELETED)
        tests = test if tests is None else tests & test
    return tests


def valid_posts(raw):
    return raw.where(is_valid_post())


def distinct_rows(df, key, order=None):
    """One row per key; which one is left open unless `order` is given."""
    if order is None:
        return df.dropDuplicates([key])
    return scale.first_per_key(df, [key], order)


def clean_posts(raw, pattern, order=None):
    """Valid posts, one per post_id, titles masked, without the nested comments."""
    posts = distinct_rows(valid_posts(raw.drop("comments")), "post_id", order)
    return posts.withColumn("title", mask_words("title", pattern))


def parse_comments(raw, *keep):
    """One row per comment of the JSON column: post_id, body, author,
    comment_id, created_utc and the `keep` columns of the post.

    Null or empty text has no comments; text that is not JSON has none either.
    """
    text = strip_control_chars("comments")
    parsed = F.when(text.isNotNull() & (text != ""), F.from_json(text, COMMENTS_JSON))
    return (
        raw.select("post_id", *keep, F.explode(parsed).alias("comment"))
        .select(
            "post_id",
            F.col("comment.body").alias("body"),
            F.col("comment.author").alias("author"),
            F.col("comment.comment_id").alias("comment_id"),
            F.expr("try_cast(comment.created_utc AS timestamp)").alias("created_utc"),
            *keep,
        )
    )


def clean_comments(raw, pattern, *keep, order=None):
    """Parsed comments, bodies masked, one per comment_id.

    Masking does not depend on the other copies, so it runs after the copies
    are gone; the rows are the same.
    """
    comments = distinct_rows(parse_comments(raw, *keep), "comment_id", order)
    return comments.withColumn("body", mask_words("body", pattern))


def comments_with_new_posts(comments, posts):
    """Comments of communities that have at least one row in `posts`."""
    communities, ok = scale.pin_small(posts.select("subreddit").distinct())
    if ok:
        return comments.join(F.broadcast(communities), "subreddit", "left_semi")
    return scale.skew_join(comments, posts.select("subreddit").distinct(), "subreddit",
                           "left_semi", ["comment_id", "post_id"])
