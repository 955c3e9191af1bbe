"""Declared table schemas: the contract every operator reads and writes."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_TS, _DATE, _B = T.TimestampType(), T.DateType(), T.BooleanType()

COMMENT = _struct(
    ("body", _S, True), ("author", _S, True), ("comment_id", _S, True),
    ("created_utc", _D, True),
)
COMMENTS_JSON = T.ArrayType(COMMENT)

# A listing entry as it lands, before the raw table.
LANDING = _struct(
    ("post_id", _S, True), ("subreddit", _S, True), ("title", _S, True),
    ("author", _S, True), ("url", _S, True), ("score", _I, True),
    ("created_utc", _D, True), ("position", _L, True),
    ("comments", COMMENTS_JSON, True),
)

TABLES = {
    "raw_posts": _struct(
        ("post_id", _S, False), ("subreddit", _S, False), ("title", _S, True),
        ("author", _S, True), ("url", _S, True), ("score", _I, True),
        ("created_utc", _TS, True), ("comments", _S, True),
    ),
    "posts": _struct(
        ("post_id", _S, False), ("subreddit", _S, True), ("title", _S, True),
        ("author", _S, True), ("url", _S, True), ("score", _I, True),
        ("created_utc", _TS, True),
    ),
    "comments": _struct(
        ("comment_id", _S, False), ("post_id", _S, True), ("body", _S, True),
        ("author", _S, True), ("created_utc", _TS, True), ("subreddit", _S, True),
    ),
    "daily_summary_data": _struct(
        ("id", _L, False), ("subreddit", _S, True), ("post_id", _S, False),
        ("post_score", _I, True), ("post_url", _S, True), ("comment_id", _S, False),
        ("summary_date", _DATE, True), ("processed_date", _TS, True),
        ("needs_processing", _B, True), ("post_content", _S, True),
        ("comment_body", _S, True),
    ),
    "text_summary_results": _struct(
        ("comment_id", _S, False), ("comment_summary", _S, True),
    ),
    "sentiment_analysis_results": _struct(
        ("comment_id", _S, False), ("sentiment_score", _D, True),
        ("sentiment_label", _S, True),
    ),
    "processing_metadata": _struct(
        ("subreddit", _S, False), ("last_processed_utc", _L, True),
        ("last_run_timestamp", _TS, True),
    ),
    "joined_summary_analysis": _struct(
        ("id", _L, True), ("subreddit", _S, True), ("post_id", _S, True),
        ("post_score", _I, True), ("post_url", _S, True), ("comment_id", _S, True),
        ("summary_date", _DATE, True), ("processed_date", _TS, True),
        ("post_content", _S, True), ("comment_body", _S, True),
        ("comment_summary", _S, True), ("sentiment_score", _D, True),
        ("sentiment_label", _S, True), ("comment_quality", _S, True),
        ("summary_quality", _S, True), ("processed_at", _TS, True),
        ("processed_by", _S, True),
    ),
    "update_processing_status": _struct(
        ("comment_id", _S, False), ("post_id", _S, False),
    ),
    # Control table: run days whose summary rows may still be unprocessed.
    "open_run_days": _struct(("run_day", _DATE, True)),
    # Results of the declared tests over each batch, when it was added.
    "test_results": _struct(
        ("run_ts", _TS, True), ("subreddit", _S, True), ("table_name", _S, True), ("column_name", _S, True),
        ("test", _S, True), ("severity", _S, True), ("failed", _L, True), ("sample", _S, True),
    ),
}

KEYS = {
    "raw_posts": ["post_id"],
    "posts": ["post_id"],
    "comments": ["comment_id"],
    "daily_summary_data": ["post_id", "comment_id"],
    "text_summary_results": ["comment_id"],
    "sentiment_analysis_results": ["comment_id"],
    "processing_metadata": ["subreddit"],
    "update_processing_status": ["comment_id", "post_id"],
}

# Directory partitioning on disk: folder column -> expression over the table.
# Event tables are also split by day, so a read after a mark skips the folders
# before it. daily_summary_data is split by the day of its run, so marking rows
# as processed rewrites the days that still hold open rows and never the settled
# history.
# Model results are split by a hash of their key, so an upsert rewrites the buckets of
# repeated keys only.
_EVENT_FOLDERS = {"subreddit": "subreddit", "created_day": "to_date(created_utc)"}
_KEY_BUCKETS = {"key_bucket": "pmod(xxhash64(comment_id), 64)"}
PARTITIONS = {
    "raw_posts": _EVENT_FOLDERS,
    "posts": _EVENT_FOLDERS,
    "comments": _EVENT_FOLDERS,
    "daily_summary_data": {"processed_day": "to_date(processed_date)"},
    "text_summary_results": _KEY_BUCKETS,
    "sentiment_analysis_results": _KEY_BUCKETS,
    "joined_summary_analysis": {"subreddit": "subreddit"},
    "test_results": {"run_day": "to_date(run_ts)"},
}

STAGING_COLUMNS = [
    "id", "subreddit", "post_id", "post_score", "post_url", "comment_id",
    "summary_date", "processed_date", "post_content", "comment_body",
]
