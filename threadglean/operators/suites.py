"""Declared checks per table, as data."""

from threadglean import constants as K
from threadglean.operators.quality import Check

_KEY = ["not_null", "unique", "is_text"]
_TEXT = ["not_null", "is_text"]
_TIME = ["not_null", "is_timestamp"]
_SCORE = ["not_null", "is_int", "expression_is_true"]


def _checks(**columns):
    """column -> test names, with the arguments each test takes."""
    args = {
        "accepted_communities": ("accepted_values", {"values": K.COMMUNITIES}),
        "accepted_sentiments": ("accepted_values", {"values": K.SENTIMENTS}),
    }
    out = []
    for column, tests in columns.items():
        for test in tests:
            name, extra = args.get(test, (test, {}))
            out.append(Check(column, name, extra))
    return out


_COMMUNITY = [*_TEXT, "accepted_communities"]
_SUMMARY_COLUMNS = dict(
    subreddit=_COMMUNITY, post_id=_TEXT, post_score=_SCORE, post_url=_TEXT, comment_id=_TEXT,
    summary_date=_TIME, post_content=_TEXT, comment_body=_TEXT)

SUITES = {
    "raw_posts": _checks(
        post_id=_KEY, subreddit=_COMMUNITY, score=_SCORE,
        comments=["not_null", "is_json"], created_utc=_TIME),
    "posts": _checks(
        post_id=_KEY, subreddit=_COMMUNITY, title=_TEXT, author=_TEXT, url=_TEXT,
        score=["is_int", "expression_is_true"], created_utc=_TIME),
    "comments": _checks(
        comment_id=_KEY, post_id=_TEXT, author=_TEXT, created_utc=_TIME),
    "daily_summary_data": _checks(id=["not_null", "is_int"], **_SUMMARY_COLUMNS),
    "current_summary_staging_source": _checks(**_SUMMARY_COLUMNS),
    "text_summary_results": _checks(comment_id=_KEY, comment_summary=_TEXT),
    "sentiment_analysis_results": _checks(
        comment_id=_KEY, sentiment_score=["not_null", "accepted_range"],
        sentiment_label=[*_TEXT, "accepted_sentiments"]),
    "current_summary_staging": _checks(id=["not_null", "is_int"], **_SUMMARY_COLUMNS),
    "joined_summary_analysis": _checks(
        comment_body=[*_TEXT, "valid_comment_length"],
        comment_summary=[*_TEXT, "summary_quality"],
        sentiment_score=["not_null", "accepted_range"],
        sentiment_label=[*_TEXT, "accepted_sentiments"]),
    "update_processing_status": _checks(comment_id=_TEXT, post_id=_TEXT),
}

# Tables that stand for one table per community: their checks run once per member.
FAMILIES = ["raw_posts", "posts", "comments"]


def declared_tests():
    """Number of declared tests, family members counted one by one."""
    return sum(len(checks) * (len(K.COMMUNITIES) if table in FAMILIES else 1)
               for table, checks in SUITES.items())
