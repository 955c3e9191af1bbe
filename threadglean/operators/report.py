"""The ranked report of each community, built from bounded pieces.

A community may hold any number of rows, so its report is never one string: it
is rows (subreddit, section, position, line_no, text) whose order gives the text.
"""

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import display_name, markdown_link, text_block, title_tags
from threadglean.operators import scale


def report_scan(joined, community=None):
    """The columns a report reads, of one community or of all."""
    rows = joined if community is None else joined.where(F.col("subreddit") == community)
    return rows.select(*K.BLOCK_FIELDS)


def ordered_rows(joined, **rank):
    """Report rows with their number in the community, highest score first."""
    order = [F.desc("post_score"), F.asc("post_id"), F.asc("comment_id")]
    return scale.rank_rows(joined, "subreddit", order, "row_no", **rank)


def text_blocks(joined, **rank):
    """One `~~~` block per row, numbered in prompt order within its community."""
    return ordered_rows(report_scan(joined), **rank).select(
        "subreddit", "row_no", text_block().alias("block"))


def prompt_parts(blocks, blocks_per_part=500, header=""):
    """The blocks of a community joined in order into parts of at most
    `blocks_per_part`, each behind `header` (a text or a column over subreddit); the parts in order are the whole
    prompt text. A model hook (`enrich.apply_model`) can run on `text`."""
    part = F.floor((F.col("row_no") - 1) / blocks_per_part).cast("long")
    ordered = F.array_sort(F.collect_list(F.struct("row_no", "block")))
    text = F.array_join(F.transform(ordered, lambda x: x["block"]), "")
    header = F.lit(header) if isinstance(header, str) else header
    return blocks.groupBy("subreddit", part.alias("part_no")).agg(
        F.count("*").alias("n_blocks"), text.alias("text")
    ).withColumn("text", F.concat(header, "text"))


# --- threads -------------------------------------------------------------------------

def threads(joined):
    """One row per post: title, url, score, number of comments.

    The post's attributes follow from its id; grouping by them as well keeps the
    count a hash aggregate, where max() of a text would sort all rows first.
    """
    return joined.groupBy("subreddit", "post_id", "post_score", "post_content", "post_url").agg(
        F.count("*").alias("n_comments"))


def rank_threads(joined, **rank):
    """Threads numbered by score within their community."""
    return scale.rank_rows(threads(joined), "subreddit",
                           [F.desc("post_score"), F.asc("post_id")], "thread_rank", **rank)


def _label_counts():
    return [F.count_if(F.col("sentiment_label") == s).alias("n_" + s.lower()) for s in K.SENTIMENTS]


def _dominant():
    most = F.greatest(*[F.col("n_" + s.lower()) for s in K.SENTIMENTS])
    dominant = F.when(F.col("n_labelled") == 0, "none")
    for s in K.SENTIMENTS:
        dominant = dominant.when(F.col("n_" + s.lower()) == most, s)
    return dominant


def thread_emotions(joined):
    """Per thread: rows per label, the dominant label (ties: Positive, Negative,
    Neutral, none), and the spread of the scores."""
    return joined.groupBy("subreddit", "post_id").agg(
        *_label_counts(),
        F.count("sentiment_label").alias("n_labelled"),
        F.round(F.avg("sentiment_score"), 6).alias("avg_score"),
        F.min("sentiment_score").alias("min_score"),
        F.max("sentiment_score").alias("max_score"),
    ).withColumn("dominant", _dominant())


def top_views(joined, k=K.VIEWS_PER_THREAD):
    """Up to `k` comments per thread: the strongest one of each label first, then
    the next strongest of each label.

    Both numberings are limited to `k` per map task before their shuffle, so a
    thread with very many comments is never sorted as a whole.
    """
    strength = [F.desc_nulls_last("sentiment_score"), F.asc("comment_id")]
    per_label = scale.top_per_group(
        joined.select("subreddit", "post_id", "comment_id", "comment_summary",
                      "sentiment_score", "sentiment_label"),
        ["subreddit", "post_id", "sentiment_label"], strength, k, "__in_label")
    return scale.top_per_group(
        per_label, ["subreddit", "post_id"], [F.asc("__in_label"), *strength], k, "view_no"
    ).drop("__in_label")


def with_title_tags(rows):
    return rows.withColumn("tags", title_tags("post_content"))


def flag_harmful(rows, harmful_ids, key="comment_id", spread=None, **skew):
    """Column `harmful`: whether the row's key is in `harmful_ids`. Rows of a hot key are
    dealt by the `spread` columns, by default all but the key."""
    ids = harmful_ids.select(key).distinct().withColumn("__harmful", F.lit(True))
    joined = scale.skew_join(rows, ids, key, "left", spread, **skew)
    return joined.select(*rows.columns, F.coalesce("__harmful", F.lit(False)).alias("harmful"))


def harmful_by_words(rows, pattern, text="comment_body"):
    """Column `harmful`: whether the text has a word of the pattern."""
    return rows.withColumn("harmful", F.coalesce(F.col(text).rlike(pattern), F.lit(False)))


def skip_harmful(rows, text="comment_summary"):
    """The one-line message in place of the analysis of a harmful item."""
    return rows.withColumn(
        text, F.when(F.col("harmful"), F.lit(K.HARMFUL_MESSAGE)).otherwise(F.col(text)))


# --- report lines -----------------------------------------------------------------------

def _front_matter_lines(report_date):
    """The title is printed with the display name; the description keeps the
    plain community name, as the stored reports have it."""
    name, day = F.col("subreddit"), F.lit(report_date).cast("date")
    return F.array(
        F.lit("---"),
        F.concat(F.lit('title: "'), display_name(name), F.lit('"')),
        F.concat(F.lit('date: "'), F.date_format(day, "yyyy-MM-dd"), F.lit('"')),
        F.concat(F.lit('description: "Analysis of top discussions and trends in the '),
                 name, F.lit(' subreddit"')),
        F.concat(F.lit('tags: ["'), name, F.lit('"]')),
        F.lit("---"),
    )


def front_matter(communities, report_date):
    """The header lines of each community's report, as rows."""
    return communities.select(
        "subreddit", F.posexplode(_front_matter_lines(report_date)).alias("line_no", "text"))


def _emotion_text():
    parts = [F.concat(F.lit(s + " "), F.col("n_" + s.lower()).cast("string")) for s in K.SENTIMENTS]
    return F.concat(
        F.lit("mostly "), F.lower("dominant"), F.lit(" ("), F.concat_ws(", ", *parts), F.lit(")"))


def _one_line(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")


def _section(number, position, lines):
    return F.struct(F.lit(number).alias("section"), position.cast("long").alias("position"),
                    lines.alias("lines"))


def report_lines(joined, report_date, **rank):
    """All reports as ordered rows: subreddit, section, position, line_no, text.

    Section 0 is the front matter, 1 the ranking, 2 the analysis by thread;
    `position` is the thread's rank, 0 for the headings. Comments are grouped by
    thread only; the first thread of a community carries its headings, so the
    whole text comes from one pass over the ranked threads.
    """
    profile = joined.groupBy(
        "subreddit", "post_id", "post_score", "post_content", "post_url"
    ).agg(*_label_counts(), F.count("sentiment_label").alias("n_labelled")
          ).withColumn("dominant", _dominant())
    views = top_views(joined).groupBy("subreddit", "post_id").agg(
        F.array_sort(F.collect_list(F.struct("view_no", "comment_summary"))).alias("views"))
    ranked = scale.rank_rows(
        profile.join(views, ["subreddit", "post_id"], "left"),
        "subreddit", [F.desc("post_score"), F.asc("post_id")], "position", **rank)
    position = F.col("position")
    score = F.concat(F.lit("(Score: "), F.col("post_score").cast("string"), F.lit(")"))
    overview = _one_line(F.try_element_at("views", F.lit(1))["comment_summary"])
    listing = F.array(
        F.concat(position.cast("string"), F.lit(". "), markdown_link("post_content", "post_url"),
                 F.lit(" "), score),
        F.concat(F.lit("    * "), overview),
    )
    points = F.transform("views", lambda v: F.concat(F.lit("    * "), _one_line(v["comment_summary"])))
    detail = F.concat(
        F.array(
            F.concat(F.lit("**["), F.coalesce("post_content", F.lit("")), F.lit(" "), score, F.lit("]("),
                     F.coalesce("post_url", F.lit("")), F.lit(")**")),
            F.concat(F.lit("*  **Summary:** "), overview),
            F.concat(F.lit("*  **Emotion:** "), _emotion_text()),
            F.lit(f"*  **Top {K.VIEWS_PER_THREAD} Points of View:**"),
        ),
        F.coalesce(points, F.array().cast("array<string>")),
        F.array(F.lit("")),
    )
    zero = F.lit(0)
    own = F.array(_section(1, position, listing), _section(2, position, detail))
    headed = F.concat(F.array(
        _section(0, zero, _front_matter_lines(report_date)),
        _section(1, zero, F.array(F.lit(K.RANKING_HEADING))),
        _section(2, zero, F.array(F.lit(K.DETAIL_HEADING)))), own)
    return (
        ranked.select("subreddit", F.inline(F.when(position == 1, headed).otherwise(own)))
        .select("subreddit", "section", "position", F.posexplode("lines").alias("line_no", "text"))
    )
