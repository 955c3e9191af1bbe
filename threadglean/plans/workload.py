"""Registered queries over the test tables, each with its comparison SQL."""

import datetime
from functools import reduce, wraps

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions import emotion as E, learned, text as X
from threadglean.operators import (
    analysis, counters, enrich, increments, ingest, masking, merge, quality, report, runmetrics, scale, summary,
    watermark)
from threadglean.operators.quality import Check
from threadglean.operators.suites import SUITES
from threadglean.plans import adapters as A
from threadglean.plans.adapters import (
    CUES, EPOCH, FOREIGN_LEXICON, LEXICON, RUN_TS, SQL_WORDS, oracle, sql_summary)
from threadglean.session import apply_settings
from threadglean.sources import files
from threadglean.streaming import logs

QUERIES, ORACLES = {}, {}


def query(sql=None, *tables):
    """Register a query under its function name, with its SQL where there is one."""

    def register(fn):
        @wraps(fn)
        def run(spark, sf_dir):
            return fn(apply_settings(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = oracle(sql, *tables)
        return run

    return register


# --- shared frames -----------------------------------------------------------------

def posts(spark, d):
    """Valid posts, one per id, titles as they came."""
    return ingest.distinct_rows(
        ingest.valid_posts(A.raw_posts(spark, d)), "post_id", [F.asc("position")]).drop("position")


def daily(spark, d):
    return summary.posts_with_comments(posts(spark, d), A.comments(spark, d), RUN_TS)


def sentiments(spark, d):
    return A.emotions(spark, d).select(
        "comment_id", F.col("score").alias("sentiment_score"),
        E.sentiment_of(F.col("emotion")).alias("sentiment_label"))


def checked(spark, d):
    return analysis.with_results(daily(spark, d), A.summaries(spark, d), sentiments(spark, d))


def joined(spark, d):
    return analysis.joined_analysis(
        daily(spark, d), A.summaries(spark, d), sentiments(spark, d), RUN_TS)


def raw_json(spark, d):
    return A.raw_threads(spark, d).withColumn("comments", F.to_json("comments"))


def _quartiles(df, ts="created_utc"):
    """Times at a quarter, half and three quarters of the table's time span."""
    micros = F.unix_micros(ts)
    span = df.agg(F.struct(F.min(micros).alias("low"), F.max(micros).alias("high"))).scalar()
    low, high = span["low"], span["high"]
    return [F.timestamp_micros(low + F.floor((high - low) * n / 4).cast("long")) for n in (1, 2, 3)]


def _at(table, n, ts="created_utc"):
    return (f"(SELECT make_timestamp(CAST(min(epoch_us({ts})) + "
            f"floor((max(epoch_us({ts})) - min(epoch_us({ts}))) * {n} / 4) AS BIGINT)) FROM {table})")


def _sql_words(words):
    return ", ".join(f"'{w}'" for w in words)


def _sql_truncate(c, n=K.CLASSIFIER_MAX_CHARS):
    head = f"substring({c}, 1, {n})"
    return f"""CASE WHEN length({c}) <= {n} THEN {c}
        WHEN regexp_extract({head}, '(?s)^(.*[.?!])', 1) <> '' THEN regexp_extract({head}, '(?s)^(.*[.?!])', 1)
        ELSE regexp_replace({head}, '(?s)^(.*) [^ ]*$', '\\1') || '...' END"""


def _sql_mask(c, lexicon=LEXICON):
    """Case is ignored for A-Z only; other letters are matched as they are listed."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hidden = (set(lexicon) | set(K.EXTRA_MASKED_WORDS)) - set(K.NEVER_MASKED_WORDS)
    hidden = sorted({w.translate(str.maketrans(upper, lower)) for w in hidden})
    word = r"[\p{L}\p{M}\p{Nd}_]"
    other = r"[^\p{L}\p{M}\p{Nd}_]"
    return f"""array_to_string(list_transform(regexp_extract_all({c}, '{word}+|{other}+'),
        lambda t: CASE WHEN translate(t, '{upper}', '{lower}') IN ({_sql_words(hidden)})
                       THEN '***' ELSE t END), '')"""


# --- merges and watermarks ----------------------------------------------------------------

@query(f"""
    WITH stored AS (SELECT DISTINCT post_id, subreddit, title, author, url, score FROM raw
                    WHERE created_utc <= {_at('raw', 2)})
    SELECT * FROM stored
    UNION ALL
    SELECT DISTINCT post_id, subreddit, title, author, url, score + 1 FROM raw
    WHERE post_id NOT IN (SELECT post_id FROM stored)""", "raw")
def insert_ignore_posts(spark, d):
    """Batch with new scores over stored posts: stored versions stay."""
    raw = A.raw_posts(spark, d)
    cols = ["post_id", "subreddit", "title", "author", "url", "score"]
    stored = raw.where(F.col("created_utc") <= _quartiles(raw)[1]).select(*cols).distinct()
    batch = raw.select(*cols).withColumn("score", F.col("score") + 1)
    return merge.insert_ignore(stored, batch, ["post_id"], [F.asc("score")])


@query(f"""
    SELECT subreddit, post_id, position, title FROM (
        SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY position, post_id) AS rn
        FROM (SELECT DISTINCT * FROM raw))
    WHERE rn <= {K.POSTS_PER_COMMUNITY} AND created_utc > {_at('raw', 2)}""", "raw")
def top_posts_per_community(spark, d):
    """Cap of the listing first, skip of seen posts second."""
    raw = A.raw_posts(spark, d)
    mark = _quartiles(raw)[1].cast("double")
    marks = raw.select("subreddit").distinct().select("subreddit", mark.alias("mark"))
    listing = raw.distinct().withColumn("created", F.col("created_utc").cast("double"))
    return ingest.capped_listing(listing, marks, created="created").select(
        "subreddit", "post_id", "position", "title")


@query(f"""
    SELECT post_id, comment_id, body, CAST(created AS DOUBLE) AS created_utc FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM threads WHERE body IS NOT NULL)
    WHERE rn <= {K.COMMENTS_PER_POST}
      AND created > (SELECT floor((min(posted) + max(posted)) / 2) FROM threads)""", "threads")
def first_comments_per_post(spark, d):
    """First ten loaded comments of each post, then only those after the mark."""
    raw = A.raw_threads(spark, d)
    mark = raw.agg(F.floor((F.min("created_utc") + F.max("created_utc")) / 2)).scalar()
    kept = ingest.capped_comments("comments", F.col("mark"))
    return raw.withColumn("mark", mark).select("post_id", F.inline(kept)).select("post_id", "comment_id", "body", "created_utc")


@query("""SELECT subreddit, max(epoch(created_utc)) AS mark FROM raw GROUP BY subreddit""", "raw")
def watermark_by_community(spark, d):
    return watermark.high_water_marks(A.raw_posts(spark, d))


@query("""SELECT coalesce(max(epoch(created_utc)), 0) AS mark FROM raw""", "raw")
def watermark_overall(spark, d):
    return watermark.high_water_mark(A.raw_posts(spark, d))


@query("SELECT max(created_utc) AS mark FROM comments", "comments")
def last_run(spark, d):
    """The largest processing time of the stored rows."""
    return watermark.last_run_mark(
        A.comments(spark, d).withColumnRenamed("created_utc", "processed_date"))


@query(f"""
    WITH stored AS (SELECT subreddit, max(epoch(created_utc)) AS mark FROM raw
                    WHERE created_utc <= {_at('raw', 2)} AND subreddit <> 'openai' GROUP BY subreddit),
         reached AS (SELECT subreddit, max(epoch(created_utc)) AS mark FROM raw GROUP BY subreddit)
    SELECT coalesce(r.subreddit, s.subreddit) AS subreddit,
           CAST(greatest(r.mark, coalesce(s.mark, 0)) AS BIGINT) AS last_processed_utc,
           CASE WHEN s.mark IS NULL OR r.mark > s.mark THEN TIMESTAMP '{RUN_TS}'
                ELSE {EPOCH} END AS last_run_timestamp
    FROM reached r FULL JOIN stored s ON r.subreddit = s.subreddit""", "raw")
def watermark_upsert(spark, d):
    """Marks move to the largest accepted time; one community has none yet."""
    raw = A.raw_posts(spark, d)
    stored = raw.where((F.col("created_utc") <= _quartiles(raw)[1]) & (F.col("subreddit") != "openai"))
    marks = stored.groupBy("subreddit").agg(
        F.max(watermark.epoch("created_utc")).cast("long").alias("last_processed_utc"),
        F.expr(EPOCH).alias("last_run_timestamp"))
    return watermark.advance_marks(marks, raw, RUN_TS)


@query(f"""
    WITH marks AS (SELECT subreddit, max(created_utc) AS mark FROM raw
                   WHERE created_utc <= {_at('raw', 2)} AND subreddit <> 'openai' GROUP BY subreddit)
    SELECT raw.* FROM raw LEFT JOIN marks ON raw.subreddit = marks.subreddit
    WHERE created_utc > coalesce(mark, TIMESTAMP '1970-01-01')""", "raw")
def incremental_rows(spark, d):
    raw = A.raw_posts(spark, d)
    stored = raw.where((F.col("created_utc") <= _quartiles(raw)[1]) & (F.col("subreddit") != "openai"))
    return watermark.new_rows_by_mark(raw, watermark.high_water_marks(stored))


@query(f"""
    SELECT subreddit, post_id, created_utc FROM posts
    WHERE created_utc > {_at('posts', 1)} AND created_utc <= {_at('posts', 3)}""", "posts")
def time_range_posts(spark, d):
    p = posts(spark, d)
    low, _, high = _quartiles(p)
    return watermark.time_range(p, low, high).select("subreddit", "post_id", "created_utc")


# --- cleaning --------------------------------------------------------------------------------

@query("SELECT post_id, subreddit, title, author, url, score, created_utc FROM valid", "valid")
def valid_posts(spark, d):
    return ingest.valid_posts(A.raw_posts(spark, d)).drop("position")


@query("SELECT * FROM posts", "posts")
def dedup_posts(spark, d):
    return posts(spark, d)


@query("SELECT comment_id, post_id, author, created_utc, body FROM comments", "comments")
def dedup_comments(spark, d):
    """Every comment comes twice, a minute apart; the earlier row stays."""
    minutes = F.explode(F.array(F.lit(0), F.lit(1)))
    twice = A.comments(spark, d).withColumn("late", minutes).withColumn(
        "created_utc", F.expr("timestampadd(MINUTE, late, created_utc)")).drop("late")
    return ingest.distinct_rows(twice, "comment_id", [F.asc("created_utc")]).select(
        "comment_id", "post_id", "author", "created_utc", "body")


@query("SELECT subreddit, post_id, created_utc FROM raw", "raw")
def union_of_communities(spark, d):
    """One table per community put together again."""
    raw = A.raw_posts(spark, d).select("subreddit", "post_id", "created_utc")
    return ingest.union_communities(
        {c: raw.where(F.col("subreddit") == c).drop("subreddit") for c in K.COMMUNITIES}
    ).select("subreddit", "post_id", "created_utc")


@query(f"SELECT post_id, {_sql_mask('title')} AS title FROM posts", "posts")
def mask_titles(spark, d):
    return ingest.clean_posts(
        A.raw_posts(spark, d), X.mask_pattern(LEXICON), [F.asc("position")]).select("post_id", "title")


@query(f"SELECT 'c' || doc_id AS comment_id, {_sql_mask('text')} AS body FROM documents")
def mask_bodies(spark, d):
    return scale.spread_small(A.read(spark, d, "documents").select("doc_id", "text")).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        X.mask_words("text", X.mask_pattern(LEXICON)).alias("body"))


@query(f"SELECT 'c' || doc_id AS comment_id, {_sql_mask('text', FOREIGN_LEXICON)} AS body FROM documents")
def mask_foreign_words(spark, d):
    """A lexicon with capitals and with words of other letters."""
    return scale.spread_small(A.read(spark, d, "documents").select("doc_id", "text")).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        X.mask_words("text", X.mask_pattern(FOREIGN_LEXICON)).alias("body"))


_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN_CHARS = r"[\p{L}\p{M}\p{Nd}_]"


@query(rf"""
    WITH lexicon AS (
        SELECT DISTINCT translate(unnest(regexp_extract_all(text, '{_RUN_CHARS}{{4,}}')), '{_AZ}', '{_az}') AS word
        FROM benchmark
        UNION SELECT unnest([{_sql_words(K.EXTRA_MASKED_WORDS)}])
    ), tokens AS (
        SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{_RUN_CHARS}+|[^\p{{L}}\p{{M}}\p{{Nd}}_]+') AS t FROM documents)
    ), masked AS (
        SELECT doc_id, string_agg(CASE WHEN word IS NULL THEN token ELSE '{K.MASK}' END, '' ORDER BY i) AS body
        FROM tokens LEFT JOIN lexicon ON word = translate(token, '{_AZ}', '{_az}')
             AND word NOT IN ({_sql_words(K.NEVER_MASKED_WORDS)})
        GROUP BY doc_id
    )
    SELECT 'c' || documents.doc_id AS comment_id, CASE WHEN text IS NOT NULL THEN coalesce(body, '') END AS body
    FROM documents LEFT JOIN masked ON masked.doc_id = documents.doc_id""")
def mask_by_lookup(spark, d):
    """Words of the benchmark as the lexicon table."""
    runs = F.regexp_extract_all("text", F.lit(f"({_RUN_CHARS}{{4,}})"), F.lit(1))
    lexicon = A.read(spark, d, "benchmark").select(F.explode(runs).alias("word"))
    documents = A.read(spark, d, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), F.col("text").alias("body"))
    return masking.mask_by_lookup(scale.spread_small(documents), "body", lexicon)


@query("""
    SELECT post_id, body, author, comment_id, make_timestamp(CAST(created * 1000000 AS BIGINT)) AS created_utc,
           subreddit FROM threads""", "threads")
def parse_comments(spark, d):
    """JSON text column to one row per comment."""
    return ingest.parse_comments(raw_json(spark, d), "subreddit")


@query(f"""
    SELECT post_id, subreddit, {_sql_mask('body')} AS body, author, comment_id FROM threads""", "threads")
def clean_comments(spark, d):
    """Parsed, one per comment_id, masked; each raw row is read twice on purpose."""
    raw = raw_json(spark, d)
    twice = raw.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return ingest.clean_comments(
        twice, X.mask_pattern(LEXICON), "subreddit", order=[F.asc("post_id")]).drop("created_utc")


@query("""
    SELECT 'c' || doc_id AS comment_id, replace(replace(replace(text, chr(10), ''), chr(13), ''), chr(9), '') AS body
    FROM documents""")
def normalize_bodies(spark, d):
    """Control characters removed from the parsed bodies."""
    return A.read(spark, d, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        X.strip_control_chars("text").alias("body"))


@query("""
    SELECT subreddit, post_id, title, author, score, created_utc FROM (SELECT DISTINCT * FROM raw)
    WHERE subreddit IN ('dataengineering', 'openai', 'datascience')""", "raw")
def allowed_communities(spark, d):
    kept = ingest.allowed_communities(
        A.raw_posts(spark, d), ["dataengineering", "openai", "datascience"])
    return ingest.distinct_rows(kept, "post_id", [F.asc("position")]).select(
        "subreddit", "post_id", "title", "author", "score", "created_utc")


@query(f"""
    SELECT post_id, coalesce(title, 'None') AS title, author, score,
           make_timestamp(epoch_us(created_utc)) AS created_utc,
           strftime(created_utc, '%Y') AS year, strftime(created_utc, '%m') AS month,
           strftime(created_utc, '%d') AS day
    FROM raw""", "raw")
def landing_to_raw(spark, d):
    """Epoch seconds to UTC time, nulls as text, and the date parts of paths."""
    entries = A.raw_posts(spark, d).withColumn("created_utc", F.col("created_utc").cast("double"))
    entries = entries.withColumn("comments", F.lit(None).cast("array<struct<body:string>>"))
    return ingest.to_raw_posts(entries).select(
        "post_id", "title", "author", "score", "created_utc",
        F.date_format("created_utc", "yyyy").alias("year"),
        F.date_format("created_utc", "MM").alias("month"),
        F.date_format("created_utc", "dd").alias("day"))


@query(f"""
    WITH listed AS (SELECT DISTINCT doc_id, post_id, subreddit, posted, (doc_id * 104729) % 1000003 AS position
                    FROM threads),
    one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY position, post_id) AS rn
                           FROM listed WHERE doc_id % 2 = 0) WHERE rn <= {K.POSTS_PER_COMMUNITY}),
    marks AS (SELECT subreddit, max(posted) AS mark FROM one GROUP BY subreddit),
    two AS (SELECT l.*, coalesce(mark, 0) AS mark FROM (
                SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY position, post_id) AS rn FROM listed) l
            LEFT JOIN marks ON l.subreddit = marks.subreddit
            WHERE rn <= {K.POSTS_PER_COMMUNITY} AND posted > coalesce(mark, 0)),
    taken AS (SELECT 1 AS batch, doc_id, post_id, subreddit, 0 AS mark FROM one
              UNION ALL SELECT 2, doc_id, post_id, subreddit, mark FROM two
              WHERE post_id NOT IN (SELECT post_id FROM one)),
    loaded AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS no FROM threads WHERE body IS NOT NULL)
    SELECT CAST(batch AS INTEGER) AS batch, t.subreddit, t.post_id, comment_id, body
    FROM taken t JOIN loaded ON loaded.doc_id = t.doc_id
    WHERE no <= {K.COMMENTS_PER_POST} AND created > mark""", "threads")
def landing_two_batches(spark, d):
    """Cap, skip, parse and mark: a listing of half the posts, then one of all."""
    listing = A.raw_threads(spark, d)
    none = listing.select("subreddit", F.lit(0.0).alias("mark")).limit(0)

    def step(entries, marks):
        kept = ingest.capped_listing(entries, marks)
        mark = F.coalesce("mark", F.lit(0.0))
        return ingest.to_raw_posts(kept.withColumn("comments", ingest.capped_comments("comments", mark)))

    one = step(listing.where(F.regexp_extract("post_id", "[0-9]+", 0).cast("long") % 2 == 0), none)
    two = step(listing, watermark.high_water_marks(one))
    fresh = merge.rows_to_insert(one, two, ["post_id"], [F.asc("created_utc")])
    both = one.withColumn("batch", F.lit(1)).unionByName(fresh.withColumn("batch", F.lit(2)))
    return ingest.parse_comments(both, "batch", "subreddit").select(
        "batch", "subreddit", "post_id", "comment_id", "body")


# --- daily summary -------------------------------------------------------------------------------

@query("SELECT * FROM daily", "daily")
def posts_comments_join(spark, d):
    return daily(spark, d).drop("processed_date")


@query(f"""
    SELECT daily.subreddit, daily.post_id, daily.comment_id FROM daily
    WHERE NOT EXISTS (SELECT 1 FROM daily s WHERE s.post_id = daily.post_id
        AND s.comment_id = daily.comment_id AND s.summary_date <= CAST({_at('comments', 2)} AS DATE))""", "daily")
def new_summaries_anti(spark, d):
    """Rows whose (post, comment) is not stored yet."""
    rows = daily(spark, d)
    stored = rows.where(F.col("summary_date") <= F.to_date(_quartiles(A.comments(spark, d))[1]))
    return summary.unseen(rows, stored).select("subreddit", "post_id", "comment_id")


@query("""
    SELECT CAST(7 + row_number() OVER (ORDER BY post_id, comment_id) AS BIGINT) AS id,
           subreddit, post_id, comment_id, post_score, summary_date, TRUE AS needs_processing
    FROM daily""", "daily")
def append_defaults(spark, d):
    """Ids after the stored 7 and the flag set."""
    stored = spark.range(8).select(F.col("id"))
    rows = daily(spark, d).select("subreddit", "post_id", "comment_id", "post_score", "summary_date")
    return summary.with_defaults(rows, stored)


@query("""
    SELECT subreddit, count(*) AS n_rows FROM daily GROUP BY ROLLUP (subreddit)""", "daily")
def new_rows_by_community(spark, d):
    return summary.counts_by_community(daily(spark, d))


@query(f"""
    WITH fresh AS (SELECT * FROM posts WHERE created_utc > {_at('posts', 3)} AND subreddit <> 'openai')
    SELECT comments.comment_id, comments.post_id, p.subreddit
    FROM comments JOIN posts p ON comments.post_id = p.post_id
    WHERE p.subreddit IN (SELECT subreddit FROM fresh)""", "posts", "comments")
def guard_empty_batch(spark, d):
    """Comments of communities without new posts are skipped as a whole."""
    p = posts(spark, d)
    fresh = p.where((F.col("created_utc") > _quartiles(p)[2]) & (F.col("subreddit") != "openai"))
    c = scale.skew_join(A.comments(spark, d).select("comment_id", "post_id"),
                        p.select("post_id", "subreddit"), "post_id", "inner", "comment_id")
    return ingest.comments_with_new_posts(c, fresh).select("comment_id", "post_id", "subreddit")


# --- staging, analysis, status ------------------------------------------------------------------------

_FLAG = "CASE WHEN lang = 'de' THEN NULL ELSE lang <> 'es' END"


def flagged(spark, d):
    """Daily rows as stored: flag false for one language, null for another."""
    flags = A.read(spark, d, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        F.expr(_FLAG).alias("needs_processing"))
    rows = daily(spark, d).withColumn("id", F.xxhash64("comment_id"))
    return rows.join(flags, "comment_id", "left")


_FLAGGED = f"""(SELECT daily.*, f.flag AS needs_processing FROM daily
    LEFT JOIN (SELECT 'c' || doc_id AS comment_id, {_FLAG} AS flag FROM documents) f
    ON daily.comment_id = f.comment_id)"""


@query(f"SELECT * EXCLUDE (needs_processing) FROM {_FLAGGED} WHERE comment_body IS NOT NULL AND needs_processing",
       "daily")
def staging_view(spark, d):
    return analysis.staging(flagged(spark, d)).drop("id", "processed_date")


@query(f"SELECT *, TIMESTAMP '{RUN_TS}' AS processed_at, '{K.PROCESSED_BY}' AS processed_by FROM joined", "joined")
def joined_analysis(spark, d):
    return joined(spark, d).drop("processed_date")


@query("""
    SELECT comment_quality, summary_quality, count(*) AS n_rows, count(sentiment_label) AS n_labelled,
           CAST(sum(length(comment_body)) AS BIGINT) AS body_chars
    FROM checked GROUP BY comment_quality, summary_quality""", "checked")
def quality_partition(spark, d):
    return checked(spark, d).groupBy("comment_quality", "summary_quality").agg(
        F.count("*").alias("n_rows"), F.count("sentiment_label").alias("n_labelled"),
        F.sum(F.length("comment_body")).alias("body_chars"))


@query("""SELECT comment_id, comment_body, comment_summary, comment_quality, summary_quality FROM checked""", "checked")
def quality_rows(spark, d):
    """Whole bodies and summaries with their labels."""
    return checked(spark, d).select(
        "comment_id", "comment_body", "comment_summary", "comment_quality", "summary_quality")


@query(f"""
    SELECT DISTINCT comment_id, post_id FROM (
        SELECT comment_id, post_id FROM daily WHERE summary_date <= CAST({_at('comments', 2)} AS DATE)
        UNION ALL SELECT comment_id, post_id FROM {_FLAGGED} WHERE needs_processing)""", "daily")
def status_merge(spark, d):
    rows = daily(spark, d)
    history = rows.where(F.col("summary_date") <= F.to_date(_quartiles(A.comments(spark, d))[1])).select(
        "comment_id", "post_id")
    return analysis.merge_status(history, analysis.staging(flagged(spark, d)))


@query("""
    WITH s AS (SELECT author AS comment_id, comment_id AS post_id FROM comments)
    SELECT comment_id, post_id, count(*) AS copies FROM (
        SELECT a.comment_id, a.post_id FROM s a LEFT JOIN s b ON a.comment_id = b.comment_id)
    GROUP BY comment_id, post_id""", "comments")
def status_self_join(spark, d):
    """Copies the self join would give, on ids that occur many times."""
    staged = A.comments(spark, d).select(
        F.col("author").alias("comment_id"), F.col("comment_id").alias("post_id"))
    return analysis.attempted(staged)


@query(f"""
    SELECT subreddit, post_id, comment_id,
           CASE WHEN comment_id IN (SELECT comment_id FROM comments WHERE created_utc <= {_at('comments', 2)})
                THEN FALSE ELSE needs_processing END AS needs_processing
    FROM {_FLAGGED}""", "daily", "comments")
def flag_update(spark, d):
    c = A.comments(spark, d)
    history = c.where(F.col("created_utc") <= _quartiles(c)[1])
    return merge.flag_processed(
        flagged(spark, d).select("subreddit", "post_id", "comment_id", "needs_processing"), history,
        hot_from=c)


# --- enrichment -------------------------------------------------------------------------------------------

@query(f"SELECT comment_id, {_sql_truncate('body')} AS truncated FROM comments", "comments")
def truncate_body(spark, d):
    return A.comments(spark, d).select("comment_id", X.truncate_sentences("body").alias("truncated"))


@query("""
    SELECT comment_id, e.emotion, upper(e.emotion[1]) || substring(e.emotion, 2) AS display_name,
           coalesce(sentiment, 'Neutral') AS sentiment
    FROM emotions e LEFT JOIN mapping m ON e.emotion = m.emotion""", "emotions", "mapping")
def sentiment_map(spark, d):
    e = F.col("emotion")
    return A.emotions(spark, d).select(
        "comment_id", "emotion", E.emotion_display_name(e).alias("display_name"),
        E.sentiment_of(F.upper(e)).alias("sentiment"))


_CHAT = "(SELECT conv_id || '-' || turn AS comment_id, text AS body FROM conversations)"


def chat(spark, d):
    return A.read(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("comment_id"), F.col("text").alias("comment_body"))


@query(f"""
    SELECT comment_id, CAST({SQL_WORDS.format(c='body')} AS INTEGER) AS n_words,
           {SQL_WORDS.format(c='body')} <= 59 AS is_short, trim(body) = '' AS is_blank FROM {_CHAT}""")
def short_text_passthrough(spark, d):
    return chat(spark, d).select(
        "comment_id", X.word_count("comment_body").alias("n_words"),
        (X.word_count("comment_body") <= K.SHORT_TEXT_MAX_WORDS).alias("is_short"),
        X.is_blank("comment_body").alias("is_blank"))


@query(f"""SELECT comment_id, {sql_summary('body')} AS comment_summary FROM
    (SELECT comment_id, body FROM comments UNION ALL SELECT * FROM {_CHAT})""", "comments")
def summarize_default(spark, d):
    """Bodies and chat turns: empty, copied or led by their first sentences."""
    bodies = A.comments(spark, d).select("comment_id", F.col("body").alias("comment_body"))
    return enrich.summarize(bodies.unionByName(chat(spark, d))).drop("error")


_CUE_TABLE = "(VALUES " + ", ".join(
    f"('{w}', '{e}')" for e, ws in CUES.items() for w in ws) + ") cues(word, emotion)"


@query(rf"""
    WITH words AS (
        SELECT comment_id, unnest(regexp_extract_all(lower({_sql_truncate('body')}), '[\p{{L}}\p{{M}}\p{{Nd}}_]+')) AS word
        FROM comments),
    hits AS (SELECT comment_id, cues.emotion, count(*) AS n FROM words JOIN {_CUE_TABLE} ON words.word = cues.word
             GROUP BY comment_id, cues.emotion),
    best AS (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY n DESC, emotion) AS rn,
                    sum(n) OVER (PARTITION BY comment_id) AS total FROM hits)
    SELECT c.comment_id, CAST(coalesce(n / total, 0) AS DOUBLE) AS sentiment_score,
           coalesce(m.sentiment, 'Neutral') AS sentiment_label,
           CASE WHEN body IS NULL OR trim(body) = '' THEN 'No content' ELSE coalesce(best.emotion, 'neutral') END AS emotion
    FROM comments c LEFT JOIN best ON c.comment_id = best.comment_id AND rn = 1
    LEFT JOIN mapping m ON best.emotion = m.emotion""", "comments", "mapping")
def sentiment_default(spark, d):
    bodies = A.comments(spark, d).select("comment_id", F.col("body").alias("comment_body"))
    return enrich.classify(bodies, cues=CUES).drop("error")


@query(f"""
    SELECT comment_id, 'third: ' || {sql_summary('body')} AS comment_summary FROM comments WHERE body IS NOT NULL
    UNION ALL
    SELECT comment_id, comment_summary FROM summaries
    WHERE comment_id NOT IN (SELECT comment_id FROM comments WHERE body IS NOT NULL)""",
       "summaries", "comments")
def summary_upsert(spark, d):
    """The last of three new summaries of a comment replaces the stored one."""
    versions = F.posexplode(F.array(F.lit("third: "), F.lit("first: "), F.lit("second: ")))
    summed = A.comments(spark, d).where(F.col("body").isNotNull()).select(
        "comment_id", X.summarize_text("body").alias("summary"))
    batch = summed.select("comment_id", "summary", versions.alias("turn", "version")).select(
        "comment_id", F.concat("version", "summary").alias("comment_summary"),
        F.pmod(F.col("turn") + 2, F.lit(3)).alias("written"))
    return enrich.upsert_summaries(A.summaries(spark, d), batch, order=[F.desc("written")])


@query("""
    WITH batch AS (
        SELECT comment_id, CASE WHEN toxic = 1 THEN 0.0 ELSE 1.0 END AS sentiment_score,
               CASE WHEN toxic = 1 THEN 'Negative' ELSE 'Positive' END AS sentiment_label
        FROM (SELECT 'c' || doc_id AS comment_id, toxic FROM labels))
    SELECT comment_id, CAST(sentiment_score AS DOUBLE) AS sentiment_score, sentiment_label FROM batch
    UNION ALL
    SELECT * FROM sentiments WHERE comment_id NOT IN (SELECT comment_id FROM batch)""", "sentiments")
def sentiment_upsert(spark, d):
    """Each comment is labelled twice, first the other way round; the last one stays."""
    toxic = (F.col("toxic") == 1) == (F.col("written") == 2)
    batch = A.read(spark, d, "labels").withColumn("written", F.explode(F.array(F.lit(2), F.lit(1)))).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        F.when(toxic, 0.0).otherwise(1.0).alias("sentiment_score"),
        F.when(toxic, "Negative").otherwise("Positive").alias("sentiment_label"), "written")
    return enrich.upsert_sentiments(sentiments(spark, d), batch, order=[F.desc("written")])


@query("""
    SELECT 'c' || doc_id AS comment_id, strpos(text, '|') > 0 AS failed,
           CASE WHEN strpos(text, '|') > 0 THEN NULL ELSE length(text) END AS n FROM documents""")
def model_hook(spark, d):
    """A batch model that refuses texts with tables: only those rows fail."""
    from pyspark.sql import types as T

    def load():
        import pandas as pd

        def model(texts):
            sizes = texts.str.len()
            if texts.str.contains("|", regex=False).any():
                raise ValueError("a table in the text")
            return pd.DataFrame({"n": sizes.astype("int64")})

        return model

    rows = scale.spread_small(A.read(spark, d, "documents").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), "text"))
    scored = enrich.apply_model(rows, "text", load, {"n": T.LongType()}, "length-model")
    return scored.select("comment_id", F.col("error").isNotNull().alias("failed"), "n")


# --- data quality ----------------------------------------------------------------------------------------------

def _dq(name, column, test, args, frame, sql_table, sql_fail, tables, key):
    """Register `dq_<name>`: one check over one table, against its predicate in SQL."""
    sql = f"""
        SELECT '{sql_table}' AS table_name, '{column}' AS column_name, '{test}' AS test, 'error' AS severity,
               count(*) FILTER (WHERE {sql_fail}) AS failed, min({key}) FILTER (WHERE {sql_fail}) AS sample
        FROM {sql_table}"""

    def run(spark, d):
        return quality.run_checks(frame(spark, d), sql_table, [Check(column, test, args)], key)

    run.__name__ = f"dq_{name}"
    query(sql, *tables)(run)


def _comments(spark, d):
    return A.comments(spark, d)


def _raw(spark, d):
    return A.raw_posts(spark, d)


_dq("not_null", "body", "not_null", {}, _comments, "comments", "body IS NULL", ["comments"], "comment_id")
_dq("accepted_values", "subreddit", "accepted_values", {"values": K.COMMUNITIES[:6]}, _raw, "raw",
    f"subreddit NOT IN ({_sql_words(K.COMMUNITIES[:6])})", ["raw"], "post_id")
_dq("is_text", "title", "is_text", {"max_length": 40, "regex": "[A-Z]"}, _raw, "raw",
    "title IS NULL OR length(title) < 1 OR length(title) > 40 OR NOT regexp_matches(title, '[A-Z]')",
    ["raw"], "post_id")
_dq("is_int", "title", "is_int", {}, _raw, "raw",
    "title IS NOT NULL AND (NOT regexp_matches(title, '^[0-9-]+$') OR TRY_CAST(title AS INTEGER) IS NULL)",
    ["raw"], "post_id")
_dq("is_bigint", "author", "is_bigint", {}, _comments, "comments",
    "author IS NOT NULL AND TRY_CAST(author AS BIGINT) IS NULL", ["comments"], "comment_id")
_dq("is_timestamp", "comment_id", "is_timestamp", {}, _comments, "comments",
    "comment_id IS NOT NULL AND TRY_CAST(comment_id AS TIMESTAMP) IS NULL", ["comments"], "comment_id")
_dq("is_string", "body", "is_string", {}, _comments, "comments",
    r"body IS NOT NULL AND (length(trim(body)) = 0 OR regexp_matches(body, '[^\x20-\x7E\s]'))",
    ["comments"], "comment_id")
_dq("expression_is_true", "score", "expression_is_true", {"low": 100}, _raw, "raw",
    "NOT (score >= 100)", ["raw"], "post_id")
_dq("accepted_range", "sentiment_score", "accepted_range", {"high": 0.5}, sentiments, "sentiments",
    "NOT (sentiment_score BETWEEN 0 AND 0.5)", ["sentiments"], "comment_id")
_dq("valid_comment_length", "comment_body", "valid_comment_length", {}, checked, "checked",
    "length(trim(comment_body)) < 2 OR length(comment_body) > 10000", ["checked"], "comment_id")
_dq("summary_quality", "comment_summary", "summary_quality", {}, checked, "checked",
    "length(comment_summary) > length(comment_body)", ["checked"], "comment_id")
_dq("sentiment_consistency", "sentiment_score", "sentiment_consistency", {}, checked, "checked",
    "sentiment_score < 0 OR sentiment_score > 1", ["checked"], "comment_id")


@query("""
    SELECT 'events' AS table_name, 'props' AS column_name, 'is_json' AS test, 'error' AS severity,
           count(*) FILTER (WHERE props IS NOT NULL AND NOT json_valid(props)) AS failed,
           min(CAST(event_id AS VARCHAR)) FILTER (WHERE NOT json_valid(props)) AS sample
    FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN '{' || props ELSE props END AS props FROM events)""")
def dq_is_json(spark, d):
    """Event properties, broken for one event type."""
    rows = A.read(spark, d, "events").withColumn(
        "props", F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props")).otherwise(F.col("props")))
    return quality.run_checks(rows, "events", [Check("props", "is_json")], "event_id")


@query("""
    SELECT 'raw' AS table_name, 'post_id' AS column_name, 'unique' AS test, 'error' AS severity,
           count(*) FILTER (WHERE n > 1) AS failed, min(post_id) FILTER (WHERE n > 1) AS sample
    FROM (SELECT post_id, count(*) AS n FROM raw GROUP BY post_id)""", "raw")
def dq_unique(spark, d):
    return quality.run_checks(A.raw_posts(spark, d), "raw", [Check("post_id", "unique")])


@query("""
    SELECT 'checked' AS table_name, 'sentiment_label' AS column_name, 'warn_if_null' AS test, 'warn' AS severity,
           count(*) FILTER (WHERE sentiment_label IS NULL) AS failed,
           min(comment_id) FILTER (WHERE sentiment_label IS NULL) AS sample FROM checked""", "checked")
def dq_warn_if_null(spark, d):
    return quality.run_checks(
        checked(spark, d), "checked", [Check("sentiment_label", "warn_if_null", severity="warn")], "comment_id")


@query("""
    SELECT post_id, title, CAST(length(title) AS INTEGER) AS text_length,
           CASE WHEN title IS NULL THEN 'NULL value' WHEN length(title) < 1 THEN 'Too short' ELSE 'Too long' END
               AS failure_reason
    FROM raw WHERE title IS NULL OR length(title) < 1 OR length(title) > 40""", "raw")
def dq_failing_rows(spark, d):
    """The rows behind a failed text check, with the reason."""
    return quality.failing_rows(
        A.raw_posts(spark, d), Check("title", "is_text", {"max_length": 40})
    ).select("post_id", "title", "text_length", "failure_reason")


def _suite_sql(suite, source, by=None):
    """One count per check of a suite over `source`, by its predicate."""
    def fails(check):
        c, values = check.column, check.args.get("values", ())
        return {
            "not_null": f"{c} IS NULL",
            "is_text": f"{c} IS NULL OR length({c}) < 1 OR length({c}) > 65535",
            "is_int": f"{c} IS NOT NULL AND (NOT regexp_matches(CAST({c} AS VARCHAR), '^[0-9-]+$') "
                      f"OR TRY_CAST(CAST({c} AS VARCHAR) AS INTEGER) IS NULL)",
            "is_timestamp": f"{c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL",
            "is_json": f"{c} IS NOT NULL AND NOT json_valid({c})",
            "expression_is_true": f"NOT ({c} >= 0)",
            "accepted_values": f"{c} NOT IN ({_sql_words(values) or 'NULL'})",
            "accepted_range": f"NOT ({c} BETWEEN 0 AND 1)",
            "valid_comment_length": f"length(trim({c})) < 2 OR length({c}) > 10000",
            "summary_quality": f"length({c}) > length(comment_body)",
        }[check.test]

    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    parts = []
    for check in SUITES[suite]:
        c = check.column
        named = f"SELECT {head}'{c}' AS column_name, '{check.test}' AS test, "
        if check.test == "unique":
            body = f"SELECT {head}{c} AS v, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY {head}{c}"
            parts.append(f"{named}count(*) FILTER (WHERE n > 1) AS failed FROM ({body}){tail}")
        else:
            parts.append(f"{named}count(*) FILTER (WHERE {fails(check)}) AS failed FROM {source}{tail}")
    return " UNION ALL ".join(parts)


def _faulty(column, every, value, c=None):
    """SQL (both dialects) that puts `value` where the score-like number `c` is divisible."""
    return f"CASE WHEN {c} % {every} = 0 THEN {value} ELSE {column} END"


# Rows that fail: texts too short or missing, times that are none, numbers over the int range,
# negative scores, unknown communities and labels, broken JSON, repeated keys.
_SUMMARY_FAULTS = {
    "id": _faulty("CAST(length(comment_body) AS BIGINT)", 5, "3000000000", "length(comment_body)"),
    "subreddit": _faulty("subreddit", 7, "'elsewhere'", "post_score"),
    "post_id": _faulty("post_id", 11, "''", "post_score"),
    "post_score": _faulty("CAST(post_score AS BIGINT)", 9, "CAST(-post_score AS BIGINT) - 3000000000", "post_score"),
    "post_url": _faulty("post_url", 13, "NULL", "post_score"),
    "comment_id": _faulty("comment_id", 17, "NULL", "length(comment_body)"),
    "summary_date": _faulty("CAST(summary_date AS STRING)", 6, "'some day'", "length(comment_body)"),
    "post_content": _faulty("post_content", 8, "''", "post_score"),
    "comment_body": _faulty("comment_body", 10, "NULL", "length(comment_body)"),
}
# table -> (frame, SQL table, column -> expression with faults)
_SUITE_INPUTS = {
    "raw_posts": (A.raw_posts, "raw", {
        "post_id": "post_id", "subreddit": _faulty("subreddit", 7, "'elsewhere'", "score"),
        "score": _faulty("CAST(score AS BIGINT)", 9, "CAST(-score AS BIGINT) - 3000000000", "score"),
        "comments": _faulty("CASE WHEN score % 4 = 0 THEN '{bad' ELSE '[{\"body\": 1}]' END", 10, "NULL", "score"),
        "created_utc": _faulty("CAST(created_utc AS STRING)", 6, "'some day'", "score")}),
    "posts": (A.raw_posts, "raw", {
        "post_id": _faulty("post_id", 11, "NULL", "score"), "subreddit": _faulty("subreddit", 7, "'elsewhere'", "score"),
        "title": "title", "author": "author", "url": _faulty("url", 8, "''", "score"),
        "score": _faulty("CAST(score AS BIGINT)", 9, "CAST(-score AS BIGINT) - 3000000000", "score"),
        "created_utc": _faulty("CAST(created_utc AS STRING)", 6, "'some day'", "score")}),
    "comments": (A.comments, "comments", {
        "comment_id": _faulty("comment_id", 7, "author", "length(body)"),
        "post_id": _faulty("post_id", 11, "NULL", "length(body)"), "author": _faulty("author", 6, "''", "length(body)"),
        "created_utc": _faulty("CAST(created_utc AS STRING)", 5, "'some day'", "length(body)")}),
    "daily_summary_data": (daily, "daily", _SUMMARY_FAULTS),
    "current_summary_staging_source": (
        daily, "daily", {c: e for c, e in _SUMMARY_FAULTS.items() if c != "id"}),
    "text_summary_results": (A.summaries, "summaries", {
        "comment_id": _faulty("comment_id", 7, "'c1'", "length(comment_summary)"),
        "comment_summary": _faulty("comment_summary", 5, "''", "length(comment_summary)")}),
    "sentiment_analysis_results": (sentiments, "sentiments", {
        "comment_id": _faulty("comment_id", 7, "NULL", "length(comment_id)"),
        "sentiment_score": "sentiment_score * 1.5",
        "sentiment_label": "CASE WHEN sentiment_score < 0.1 THEN 'Mixed' WHEN sentiment_score < 0.2 THEN NULL "
                           "ELSE sentiment_label END"}),
    "current_summary_staging": (daily, "daily", _SUMMARY_FAULTS),
    "joined_summary_analysis": (checked, "checked", {
        "comment_body": "comment_body", "comment_summary": "comment_summary",
        "sentiment_score": "sentiment_score * 1.5", "sentiment_label": "sentiment_label"}),
    "update_processing_status": (daily, "daily", {
        c: _SUMMARY_FAULTS[c] for c in ("comment_id", "post_id")}),
}


def _suite_query(suite, frame, table, columns, by=None, name=None):
    """Register a whole suite over a table with faults, in one pass."""
    shown = ", ".join(f"{e} AS {c}" for c, e in columns.items())

    def run(spark, d):
        rows = frame(spark, d).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        return quality.run_checks(rows, suite, SUITES[suite], by=by).select(
            *([by] if by else []), "column_name", "test", "failed")

    run.__name__ = name or f"dq_suite_{suite}"
    query(_suite_sql(suite, f"(SELECT {shown} FROM {table})", by), table)(run)


for _suite, (_frame, _source, _columns) in _SUITE_INPUTS.items():
    _suite_query(_suite, _frame, _source, _columns)
_suite_query("posts", *_SUITE_INPUTS["posts"], name="dq_suite")
_suite_query("posts", *_SUITE_INPUTS["posts"], by="subreddit", name="dq_by_community")


@query(_suite_sql("posts", "(SELECT {} FROM raw)".format(
    ", ".join(f"{e} AS {c}" for c, e in _SUITE_INPUTS["posts"][2].items()))), "raw")
def dq_incremental(spark, d):
    """The suite of posts over two batches, each tested once, equals the suite over all rows."""
    frame, _, columns = _SUITE_INPUTS["posts"]
    rows = frame(spark, d).select(
        *[F.expr(e).alias(c) for c, e in columns.items()], (F.col("score") % 3 == 0).alias("early"))
    first, second = rows.where("early").drop("early"), rows.where("not early").drop("early")
    results = [increments.batch_results(first, "posts", SUITES["posts"]),
               increments.batch_results(second, "posts", SUITES["posts"], stored=first)]
    return increments.merge_results(results).select("column_name", "test", "failed")


@query("""
    SELECT column_name, n_null FROM (
        SELECT count(*) FILTER (WHERE comment_summary IS NULL) AS comment_summary,
               count(*) FILTER (WHERE sentiment_score IS NULL) AS sentiment_score,
               count(*) FILTER (WHERE sentiment_label IS NULL) AS sentiment_label FROM checked)
    UNPIVOT (n_null FOR column_name IN (comment_summary, sentiment_score, sentiment_label))""", "checked")
def null_counts(spark, d):
    return counters.null_counts(checked(spark, d), ["comment_summary", "sentiment_score", "sentiment_label"])


@query("""
    SELECT 'joined_summary_analysis' AS table_name, count(*) AS n_rows FROM joined
    UNION ALL SELECT 'text_summary_results', count(*) FROM summaries
    UNION ALL SELECT 'sentiment_analysis_results', count(*) FROM sentiments""",
       "joined", "summaries", "sentiments")
def row_counts(spark, d):
    return counters.row_counts({
        "joined_summary_analysis": joined(spark, d), "text_summary_results": A.summaries(spark, d),
        "sentiment_analysis_results": sentiments(spark, d)})


# --- report ----------------------------------------------------------------------------------------------------------

_THREADS = """(SELECT subreddit, post_id, post_score, post_content, post_url, count(*) AS n_comments
    FROM joined GROUP BY ALL)"""


@query(f"""
    SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY post_score DESC, post_id) AS thread_rank
    FROM {_THREADS}""", "joined")
def thread_ranking(spark, d):
    """Valid commented posts per community, ranked by score."""
    return report.rank_threads(joined(spark, d))


_EMOTIONS = """(SELECT *, CASE WHEN n_labelled = 0 THEN 'none'
        WHEN n_positive >= n_negative AND n_positive >= n_neutral THEN 'Positive'
        WHEN n_negative >= n_neutral THEN 'Negative' ELSE 'Neutral' END AS dominant FROM (
    SELECT subreddit, post_id, count(*) FILTER (WHERE sentiment_label = 'Positive') AS n_positive,
           count(*) FILTER (WHERE sentiment_label = 'Negative') AS n_negative,
           count(*) FILTER (WHERE sentiment_label = 'Neutral') AS n_neutral,
           count(sentiment_label) AS n_labelled, round(avg(sentiment_score), 6) AS avg_score,
           min(sentiment_score) AS min_score, max(sentiment_score) AS max_score
    FROM joined GROUP BY subreddit, post_id))"""


@query(f"SELECT * FROM {_EMOTIONS}", "joined")
def thread_emotions(spark, d):
    return report.thread_emotions(joined(spark, d))


_VIEWS = """(SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY subreddit, post_id
                                 ORDER BY in_label, sentiment_score DESC NULLS LAST, comment_id) AS view_no
    FROM (SELECT subreddit, post_id, comment_id, comment_summary, sentiment_score, sentiment_label,
                 row_number() OVER (PARTITION BY subreddit, post_id, sentiment_label
                                    ORDER BY sentiment_score DESC NULLS LAST, comment_id) AS in_label
          FROM joined)) WHERE view_no <= 3)"""


@query(f"SELECT * EXCLUDE (in_label) REPLACE (CAST(view_no AS INTEGER) AS view_no) FROM {_VIEWS}", "joined")
def top3_views(spark, d):
    return report.top_views(joined(spark, d))


_TAGGED = """(SELECT post_id, url, CASE WHEN score % 3 = 0 THEN '[D] ' || title WHEN score % 3 = 1
    THEN '[D] [R] ' || title || ' [P]' ELSE title END AS title FROM posts)"""


def tagged(spark, d):
    """Posts with none, one or several tags in their titles."""
    s, t = F.col("score") % 3, F.col("title")
    return posts(spark, d).select("post_id", "url", F.when(s == 0, F.concat(F.lit("[D] "), t)).when(
        s == 1, F.concat(F.lit("[D] [R] "), t, F.lit(" [P]"))).otherwise(t).alias("title"))


@query(rf"""
    SELECT post_id, array_to_string(regexp_extract_all(title, '\[([^\]]+)\]', 1), ',') AS tags
    FROM {_TAGGED}""", "posts")
def title_tags(spark, d):
    return tagged(spark, d).select("post_id", F.concat_ws(",", X.title_tags("title")).alias("tags"))


@query(f"SELECT post_id, '[' || title || '](' || url || ')' AS link FROM {_TAGGED}", "posts")
def markdown_links(spark, d):
    return tagged(spark, d).select("post_id", X.markdown_link("title", "url").alias("link"))


_NAMES = "CASE subreddit " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in K.COMMUNITY_DISPLAY_NAMES.items()) + " ELSE subreddit END || ' Subreddit'"


@query(f"""
    SELECT subreddit, unnest(lines) AS text, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no FROM (
        SELECT subreddit, ['---', 'title: "' || {_NAMES} || '"', 'date: "2025-01-09"',
               'description: "Analysis of top discussions and trends in the ' || subreddit || ' subreddit"',
               'tags: ["' || subreddit || '"]', '---'] AS lines
        FROM (SELECT DISTINCT subreddit FROM posts))""", "posts")
def front_matter(spark, d):
    return report.front_matter(posts(spark, d).select("subreddit").distinct(), "2025-01-09").select(
        "subreddit", "text", "line_no")


@query(f"""
    SELECT post_id, replace(text, 'title: "' || subreddit || ' subreddit"', 'title: "' || {_NAMES} || '"') AS text
    FROM (SELECT post_id, subreddit, '---' || chr(10) || 'title: "' || subreddit || ' subreddit"' || chr(10) || title AS text
          FROM posts)""", "posts")
def retitled_reports(spark, d):
    """Texts of an outside model with the community's display name in the title."""
    text = F.concat(F.lit('---\ntitle: "'), F.col("subreddit"), F.lit(' subreddit"\n'), F.col("title"))
    return posts(spark, d).select("post_id", X.retitle(text, "subreddit").alias("text"))


_BLOCK = "'~~~' || " + " || ".join(
    f"chr(10) || '    {f}: ' || coalesce(CAST({f} AS VARCHAR), 'None')" for f in K.BLOCK_FIELDS
) + " || chr(10) || '    '"


@query(f"""
    SELECT subreddit, row_number() OVER (PARTITION BY subreddit
               ORDER BY post_score DESC, post_id, comment_id) AS row_no, {_BLOCK} AS block
    FROM joined""", "joined")
def text_blocks(spark, d):
    return report.text_blocks(joined(spark, d))


@query(f"""
    SELECT subreddit, CAST(floor((row_no - 1) / 20) AS BIGINT) AS part_no, count(*) AS n_blocks,
           string_agg(block, '' ORDER BY row_no) AS text
    FROM (SELECT subreddit, row_number() OVER (PARTITION BY subreddit
               ORDER BY post_score DESC, post_id, comment_id) AS row_no, {_BLOCK} AS block FROM joined)
    GROUP BY subreddit, part_no""", "joined")
def prompt_parts(spark, d):
    """The prompt text of each community as ordered parts."""
    return report.prompt_parts(report.text_blocks(joined(spark, d)), 20)


@query("""
    SELECT subreddit, post_id, post_score, comment_id, sentiment_label FROM joined
    WHERE subreddit = 'machinelearning'""", "joined")
def community_report_scan(spark, d):
    return report.report_scan(joined(spark, d), "machinelearning").select(
        "subreddit", "post_id", "post_score", "comment_id", "sentiment_label")


_FENCED = """(SELECT doc_id, '```md' || chr(10) || replace(text, '. ', '.  ' || chr(10) || '```  ' || chr(10) || ' ')
    || chr(10) || '```' AS text FROM documents)"""


@query(rf"""
    SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)),
               lambda x: rtrim(replace(x, '```', '')) <> '' OR trim(x) = ''),
               lambda x: rtrim(replace(x, '```', '')) || chr(10)), '') AS text FROM {_FENCED}""")
def clean_markdown(spark, d):
    """Fenced texts with blank and trailing-blank lines."""
    fenced = F.concat(
        F.lit("```md\n"), F.replace("text", F.lit(". "), F.lit(".  \n```  \n ")), F.lit("\n```"))
    return A.read(spark, d, "documents").select("doc_id", X.clean_markdown(fenced).alias("text"))


@query(f"""
    SELECT subreddit, post_id, j.comment_id, h.comment_id IS NOT NULL AS harmful,
           CASE WHEN h.comment_id IS NOT NULL THEN '{K.HARMFUL_MESSAGE}' ELSE comment_summary END AS comment_summary
    FROM joined j LEFT JOIN harmful h ON j.comment_id = h.comment_id""", "joined", "harmful")
def harmful_skip(spark, d):
    rows = report.flag_harmful(
        joined(spark, d), A.harmful_ids(spark, d), hot_from=A.comments(spark, d))
    return report.skip_harmful(rows).select(
        "subreddit", "post_id", "comment_id", "harmful", "comment_summary")


@query(r"""
    SELECT comment_id, coalesce(len(list_filter(regexp_extract_all(body, '[\p{L}\p{M}\p{Nd}_]+'),
               lambda t: lower(t) IN ('license', 'password', 'erer', 'thth'))) > 0, FALSE) AS harmful
    FROM comments""", "comments")
def harmful_words(spark, d):
    """Comments flagged by listed words."""
    pattern = "(?i)(?:" + X.words_regex(["license", "password", "erer", "thth"]) + ")"
    return report.harmful_by_words(A.comments(spark, d), pattern, "body").select("comment_id", "harmful")


@query(rf"""
    WITH words AS (
        SELECT DISTINCT doc_id, ('0x' || left(md5(unnest(regexp_extract_all(lower(text), '\p{{L}}+'))), 4))::INTEGER
            AS bucket FROM documents
    ), chosen AS (
        SELECT l.doc_id, label FROM (
            SELECT doc_id, min(toxic) = 1 AS label FROM labels WHERE toxic IS NOT NULL AND quality IS NOT NULL
            GROUP BY doc_id HAVING count(*) = 1 ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT {learned.MAX_LABELLED}) l
        JOIN documents ON documents.doc_id = l.doc_id
    ), totals AS (
        SELECT count(*) FILTER (label) AS a, count(*) FILTER (NOT label) AS b FROM chosen
    ), counts AS (
        SELECT bucket, count(*) FILTER (label) AS yes, count(*) FILTER (NOT label) AS no
        FROM words JOIN chosen ON chosen.doc_id = words.doc_id GROUP BY bucket
    ), weights AS (
        SELECT bucket, floor(1000 * ln(((2 * yes + 1) * (2 * b + 2))::DOUBLE
                                       / ((2 * no + 1) * (2 * a + 2))::DOUBLE))::BIGINT AS weight
        FROM counts, totals WHERE 2 * (
            CASE WHEN yes > 0 THEN yes * ln(yes * (a + b) / ((yes + no) * a)) ELSE 0 END
            + CASE WHEN no > 0 THEN no * ln(no * (a + b) / ((yes + no) * b)) ELSE 0 END
            + CASE WHEN yes < a THEN (a - yes) * ln((a - yes) * (a + b) / ((a + b - yes - no) * a)) ELSE 0 END
            + CASE WHEN no < b THEN (b - no) * ln((b - no) * (a + b) / ((a + b - yes - no) * b)) ELSE 0 END
            ) >= {learned.LEAST_G2}
    ), sums AS (
        SELECT doc_id, sum(weight)::BIGINT AS found
        FROM words JOIN weights ON weights.bucket = words.bucket GROUP BY doc_id
    ), prior AS (
        SELECT floor(1000 * ln(a / b))::BIGINT AS prior FROM totals
    )
    SELECT 'c' || documents.doc_id AS comment_id, coalesce(found, 0) + prior AS score,
           text IS NOT NULL AND coalesce(found, 0) + prior > 0 AS harmful
    FROM prior, documents LEFT JOIN sums ON sums.doc_id = documents.doc_id""")
def classify_learned(spark, d):
    """Harmful texts by a classifier trained on the labelled ones."""
    documents = A.read(spark, d, "documents").select("doc_id", "text")
    model = learned.train(
        learned.labelled_rows(documents, A.read(spark, d, "labels"), "doc_id"), "toxic = 1", "text")
    return scale.spread_small(documents).select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        model.score("text").alias("score"), model.flags("text").alias("harmful"))


_ONE_LINE = r"regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')"
_SCORE = "'(Score: ' || post_score || ')'"


_BODY = f"""
    WITH views AS (SELECT * FROM {_VIEWS}),
    top AS (SELECT subreddit, post_id, first(comment_summary ORDER BY view_no) AS summary,
                   list('    * ' || {_ONE_LINE.format(c='comment_summary')} ORDER BY view_no) AS points
            FROM views GROUP BY subreddit, post_id),
    ranked AS (
        SELECT t.*, e.* EXCLUDE (subreddit, post_id), {_ONE_LINE.format(c='summary')} AS summary, points,
               row_number() OVER (PARTITION BY t.subreddit ORDER BY post_score DESC, t.post_id) AS position
        FROM {_THREADS} t JOIN {_EMOTIONS} e ON t.subreddit = e.subreddit AND t.post_id = e.post_id
        JOIN top ON t.subreddit = top.subreddit AND t.post_id = top.post_id),
    listing AS (SELECT subreddit, 1 AS section, position,
        [position || '. [' || post_content || '](' || post_url || ') ' || {_SCORE}, '    * ' || summary] AS lines
        FROM ranked),
    detail AS (SELECT subreddit, 2 AS section, position, list_concat(
        ['**[' || post_content || ' ' || {_SCORE} || '](' || post_url || ')**', '*  **Summary:** ' || summary,
         '*  **Emotion:** mostly ' || lower(dominant) || ' (Positive ' || n_positive || ', Negative '
             || n_negative || ', Neutral ' || n_neutral || ')', '*  **Top 3 Points of View:**'],
        points, ['']) AS lines FROM ranked)
    SELECT subreddit, section, position, unnest(lines) AS text,
           CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no
    FROM (SELECT * FROM listing UNION ALL SELECT * FROM detail)"""


@query(_BODY, "joined")
def report_body(spark, d):
    """Ranking and analysis lines of all reports."""
    lines = report.report_lines(report.report_scan(joined(spark, d)), "2025-01-09")
    return lines.where(F.col("position") > 0).select("subreddit", "section", "position", "text", "line_no")


_HEADS = f"""
    SELECT subreddit, 0 AS section, 0 AS position, unnest(lines) AS text,
           CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no FROM (
        SELECT subreddit, ['---', 'title: "' || {_NAMES} || '"', 'date: "2025-01-09"',
               'description: "Analysis of top discussions and trends in the ' || subreddit || ' subreddit"',
               'tags: ["' || subreddit || '"]', '---'] AS lines FROM (SELECT DISTINCT subreddit FROM joined))
    UNION ALL SELECT DISTINCT subreddit, 1, 0, '{K.RANKING_HEADING}', 0 FROM joined
    UNION ALL SELECT DISTINCT subreddit, 2, 0, '{K.DETAIL_HEADING}', 0 FROM joined"""


@query(f"""
    SELECT subreddit, CAST((no - 1) // 200 + 1 AS INTEGER) AS file_no, string_agg(text || chr(10), '' ORDER BY no) AS text
    FROM (SELECT subreddit, text, row_number() OVER (PARTITION BY subreddit ORDER BY section, position, line_no) AS no
          FROM (SELECT subreddit, section, position, text, line_no FROM ({_BODY})
                UNION ALL SELECT subreddit, section, position, text, line_no FROM ({_HEADS})))
    GROUP BY subreddit, file_no""", "joined")
def markdown_reports(spark, d):
    """The reports written as Markdown files of at most 200 lines, twice, and read back."""
    lines = scale.cut_lineage(report.report_lines(report.report_scan(joined(spark, d)), "2025-01-09"))
    root, day = scale.scratch_folder(spark, "reports"), datetime.date(2025, 1, 9)
    files.write_markdown(lines.withColumn("text", F.lit("older")), root, day, lines_per_file=50)
    files.write_markdown(lines, root, day, lines_per_file=200)
    return files.read_markdown_reports(spark, root, day)


# --- run metrics -------------------------------------------------------------------------------------------------------------

_RUN = "dag_id, run_id, task_id, attempt"


def _last_sql(value, when):
    return f"arg_max({value}, event_id) FILTER (WHERE {when})"


def _count_sql(event):
    return f"count(*) FILTER (WHERE event_type = '{event}')"


def _timed_sql(task, columns):
    """Metrics of a task whose start is a view event and whose end a purchase."""
    start = _last_sql("logged", "event_type = 'view'")
    end = _last_sql("logged", "event_type = 'purchase'")
    return f"""
    SELECT *, CAST(CASE WHEN success THEN 1 ELSE attempt + 1 END AS INTEGER) AS next_attempt FROM (
        SELECT {_RUN}, {columns}, {_count_sql('purchase')} > 0 AS success,
               round(epoch({end}) - epoch({start}), 6) AS duration_seconds, FALSE AS error
        FROM logs WHERE task_id = '{task}' GROUP BY {_RUN})"""


def _metrics(spark, d, kind):
    lines = A.log_lines(spark, d)
    return runmetrics.extract_all(lines, {kind: [kind]})[kind]


_INGEST_SQL = _timed_sql("ingest_preprocess", f"""{_count_sql('click')} AS processed_posts,
    coalesce({_last_sql('event_id', "event_type = 'signup'")}, 0) AS total_summaries""")


@query(_INGEST_SQL, "logs")
def log_ingest_metrics(spark, d):
    return _metrics(spark, d, "ingest_preprocess")


_SUMMARIZE_SQL = _timed_sql("summarize", f"""{_count_sql('click')} AS summaries_added,
    {_count_sql('signup')} AS short_comments,
    {_count_sql('click')} + {_count_sql('signup')} AS total_processed""")


@query(_SUMMARIZE_SQL, "logs")
def log_summarize_metrics(spark, d):
    return _metrics(spark, d, "summarize")


def deliver_logs(lines, root, delivery):
    """Log lines as files under dag_id/run_id/task_id/attempt of one delivery."""
    keys = runmetrics.RUN_KEYS
    (lines.repartition(*keys).sortWithinPartitions(*keys, "line_no").select(*keys, "value")
     .write.partitionBy(*keys).text(f"{root}/delivery={delivery}"))


@query(_SUMMARIZE_SQL, "logs")
def log_stream_metrics(spark, d):
    """Logs delivered as files twice, in the middle of their attempts; each file is read once."""
    lines = scale.cut_lineage(A.log_lines(spark, d).where("task_id = 'summarize'"))
    half = lines.agg(F.floor((F.min("line_no") + F.max("line_no")) / 2).alias("half")).scalar()
    root = scale.scratch_folder(spark, "logs")
    for delivery, part in ((1, lines.where(F.col("line_no") <= half)), (2, lines.where(F.col("line_no") > half))):
        deliver_logs(part, f"{root}/landed", delivery)
        logs.collect_metrics(spark, f"{root}/landed", "summarize", ["summarize"], f"{root}/metrics", f"{root}/progress")
    return logs.stored_metrics(spark, f"{root}/metrics", "summarize")


_SENTIMENT_SQL = _timed_sql("sentiment", f"{_count_sql('click')} AS processed")


@query(_SENTIMENT_SQL, "logs")
def log_sentiment_metrics(spark, d):
    return _metrics(spark, d, "sentiment")


_TESTS_SQL = _timed_sql("tests", f"""{_count_sql('click')} AS tests_passed,
    {_count_sql('signup')} AS tests_failed, {_count_sql('click')} + {_count_sql('signup')} AS tests_total""")


@query(_TESTS_SQL, "logs")
def log_test_metrics(spark, d):
    return _metrics(spark, d, "tests")


def _printed_sql(task):
    return f"""
    SELECT *, CAST(CASE WHEN success THEN 1 ELSE attempt + 1 END AS INTEGER) AS next_attempt FROM (
        SELECT {_RUN}, {_last_sql('value', "event_type = 'click'")} AS duration_seconds,
               {_count_sql('purchase')} > 0 AS success, FALSE AS error
        FROM logs WHERE task_id = '{task}' GROUP BY {_RUN})"""


_JOIN_SQL = f"SELECT *, (SELECT count(*) FROM joined) AS rows_processed FROM ({_printed_sql('join')})"
_STATUS_SQL = f"""SELECT *, (SELECT count(*) FROM (SELECT DISTINCT comment_id, post_id FROM daily)) AS rows_processed
    FROM ({_printed_sql('processing_status')})"""


def status_rows(spark, d):
    return daily(spark, d).select("comment_id", "post_id").distinct()


@query(_JOIN_SQL, "logs", "joined")
def log_join_metrics(spark, d):
    """With the row count of the joined table."""
    return runmetrics.with_table_rows(_metrics(spark, d, "join"), joined(spark, d), "rows_processed")


@query(_STATUS_SQL, "logs", "daily")
def log_status_metrics(spark, d):
    """With the row count of the status table."""
    return runmetrics.with_table_rows(
        _metrics(spark, d, "processing_status"), status_rows(spark, d), "rows_processed")


_REPORT_SQL = f"""
    SELECT *, CAST(CASE WHEN success THEN 1 ELSE attempt + 1 END AS INTEGER) AS next_attempt FROM (
        SELECT {_RUN}, {_count_sql('view')} AS subreddits_processed, {_count_sql('click')} AS outputs_generated,
               coalesce(round(epoch(iso_last) - epoch(iso_first), 6), 0) AS duration_seconds,
               {_count_sql('view')} = {_count_sql('click')} AS success,
               {_count_sql('view')} > 0 AND (iso_first IS NULL OR iso_last IS NULL) AS error
        FROM (SELECT *, first(iso ORDER BY event_id DESC) OVER w AS iso_last,
                     first(CASE WHEN event_type = 'view' THEN iso END
                           ORDER BY CASE WHEN event_type = 'view' THEN event_id END) OVER w AS iso_first
              FROM (SELECT *, CASE WHEN event_id % 5 <> 0 THEN logged END AS iso FROM logs WHERE task_id = 'report')
              WINDOW w AS (PARTITION BY {_RUN}))
        GROUP BY {_RUN}, iso_last, iso_first)"""


@query(_REPORT_SQL, "logs")
def log_report_metrics(spark, d):
    return _metrics(spark, d, "report")


# kind -> (SQL of its metrics, gauges: printed name -> column)
_KINDS = {
    "ingest_preprocess": (_INGEST_SQL, {"processed_posts": "processed_posts", "total_summaries": "total_summaries"}),
    "summarize": (_SUMMARIZE_SQL, {"summaries_added": "summaries_added", "short_comments": "short_comments",
                                   "total_processed": "total_processed"}),
    "sentiment": (_SENTIMENT_SQL, {"processed": "processed"}),
    "tests": (_TESTS_SQL, {"tests.passed": "tests_passed", "tests.failed": "tests_failed", "tests.total": "tests_total"}),
    "join": (_JOIN_SQL, {"rows_processed": "rows_processed"}),
    "processing_status": (_STATUS_SQL, {"rows_processed": "rows_processed"}),
    "report": (_REPORT_SQL, {"subreddits_processed": "subreddits_processed", "outputs_generated": "outputs_generated"}),
}


def _series_sql():
    """All points: a timing only where a duration was measured, and of the report always."""
    parts = []
    for kind, (sql, gauges) in _KINDS.items():
        prefix = f"'{runmetrics.METRIC_PREFIXES[kind]}.'" + (" || task_id || '.'" if kind == "tests" else "")

        def point(name, of, value, when):
            return (f"SELECT {_RUN}, {prefix} || {name} AS metric, '{of}' AS kind, "
                    f"CAST({value} AS DOUBLE) AS value FROM ({sql}) WHERE {when}")

        for name, column in {**gauges, "current_attempt": "attempt"}.items():
            parts.append(point(f"'{name}'", "gauge", column, "NOT error"))
        parts.append(point("CASE WHEN success THEN 'success' ELSE 'retry' END", "counter", 1, "NOT error"))
        parts.append(point("'duration'", "timing", "round(duration_seconds * 1000, 3)",
                           "NOT error AND duration_seconds IS NOT NULL"))
        parts.append(point("'error'", "counter", 1, "error"))
    return "\nUNION ALL ".join(parts)


def _run_metrics(spark, d):
    """Metrics of all seven kinds of task."""
    return runmetrics.run_metrics(
        A.log_lines(spark, d), {kind: [kind] for kind in _KINDS},
        {"join": joined(spark, d), "processing_status": status_rows(spark, d)})


@query(_series_sql(), "logs", "joined", "daily")
def metric_series(spark, d):
    return runmetrics.all_series(_run_metrics(spark, d)).withColumn("value", F.round("value", 3))


# The stages of tests that have exported names stand for the one stage of the log lines.
_EXPORTED = {("dbt.tests." + k.split(".", 2)[2] if k.startswith("dbt.test_raw_sources.") else k): v
             for k, v in runmetrics.EXPORTED_NAMES.items()}


@query(f"""
    SELECT {_RUN}, name, value FROM ({_series_sql()}) s
    JOIN (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _EXPORTED.items())}) n(metric, name) ON s.metric = n.metric""",
       "logs", "joined", "daily")
def exported_series(spark, d):
    """Metric points under the names the dashboards use."""
    series = runmetrics.all_series(_run_metrics(spark, d))
    return runmetrics.export_names(series, _EXPORTED).select(
        *runmetrics.RUN_KEYS, "name", F.round("value", 3).alias("value"))


@query("""
    SELECT task_id, passed, failed FROM (
        SELECT task_id, count(*) FILTER (WHERE event_type = 'click') AS passed,
               count(*) FILTER (WHERE event_type = 'signup') AS failed
        FROM logs WHERE task_id = 'tests' GROUP BY task_id)""", "logs")
def tests_panel(spark, d):
    return runmetrics.test_result_panel(_metrics(spark, d, "tests"))


_BUCKETS = [str(b) for b in K.DURATION_BOUNDS_SECONDS]


@query(" UNION ALL ".join(
    f"SELECT task_id, {i} AS bucket_no, '{b}' AS le, count(*) FILTER (WHERE value <= {b}) AS n FROM logs GROUP BY task_id"
    for i, b in enumerate(_BUCKETS)) + f"""
    UNION ALL SELECT task_id, {len(_BUCKETS)}, '+Inf', count(value) FROM logs GROUP BY task_id""", "logs")
def duration_histogram(spark, d):
    return runmetrics.duration_histogram(A.log_lines(spark, d), value="seconds")


@query("SELECT task_id, round(sum(value) / 60, 6) AS minutes FROM logs GROUP BY task_id", "logs")
def duration_minutes(spark, d):
    totals = runmetrics.duration_minutes(A.log_lines(spark, d), value="seconds")
    return totals.withColumn("minutes", F.round("minutes", 6))


_DURATIONS_SQL = "(" + " UNION ALL ".join(
    f"SELECT task_id, duration_seconds FROM ({sql})" for sql, _ in _KINDS.values()) + ")"


def _durations(spark, d):
    frames = [frame.select("task_id", "duration_seconds") for frame in _run_metrics(spark, d).values()]
    return reduce(lambda a, b: a.unionByName(b), frames)


@query(" UNION ALL ".join(
    f"SELECT task_id, {i} AS bucket_no, '{b}' AS le, count(*) FILTER (WHERE duration_seconds <= {b}) AS n "
    f"FROM {_DURATIONS_SQL} GROUP BY task_id" for i, b in enumerate(_BUCKETS)) + f"""
    UNION ALL SELECT task_id, {len(_BUCKETS)}, '+Inf', count(duration_seconds) FROM {_DURATIONS_SQL} GROUP BY task_id""",
       "logs", "joined", "daily")
def extracted_duration_histogram(spark, d):
    """Buckets of the durations taken from the log lines."""
    return runmetrics.duration_histogram(_durations(spark, d))


@query(f"SELECT task_id, round(sum(duration_seconds) / 60, 6) AS minutes FROM {_DURATIONS_SQL} GROUP BY task_id",
       "logs", "joined", "daily")
def extracted_duration_minutes(spark, d):
    return runmetrics.duration_minutes(_durations(spark, d)).withColumn("minutes", F.round("minutes", 6))


@query("""
    SELECT task_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, count(*) AS n_errors,
           count(*) / 300 AS errors_per_second
    FROM logs WHERE event_type = 'error' GROUP BY ALL""", "logs")
def error_rate_5m(spark, d):
    return runmetrics.error_rate(A.log_lines(spark, d).where(F.col("event_type") == "error"))


@query("""
    WITH errors AS (SELECT task_id, ts FROM logs WHERE event_type = 'error'),
    grid AS (
        SELECT DISTINCT e.task_id, unnest(range(low, high + INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS window_end
        FROM (SELECT DISTINCT task_id FROM errors) e,
             (SELECT time_bucket(INTERVAL 1 MINUTE, min(ts)) + INTERVAL 1 MINUTE AS low,
                     time_bucket(INTERVAL 1 MINUTE, max(ts)) + INTERVAL 5 MINUTE AS high FROM errors)
    ), steps AS (
        SELECT task_id, time_bucket(INTERVAL 1 MINUTE, ts) + INTERVAL 1 MINUTE AS step, count(*) AS n
        FROM errors GROUP BY ALL
    ), counted AS (
        SELECT grid.task_id, window_end, coalesce(n, 0) AS n
        FROM grid LEFT JOIN steps ON steps.task_id = grid.task_id AND step = window_end
    )
    SELECT task_id, window_end, CAST(sum(n) OVER w AS BIGINT) AS n_errors, sum(n) OVER w / 300 AS errors_per_second
    FROM counted WINDOW w AS (PARTITION BY task_id ORDER BY window_end ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""", "logs")
def error_rate_sliding(spark, d):
    """The rate over the last five minutes at every minute, quiet ones included."""
    errors = A.log_lines(spark, d).where(F.col("event_type") == "error").select("task_id", "ts")
    return runmetrics.sliding_error_rate(errors)


@query("SELECT task_id, max(attempt) AS attempt FROM logs GROUP BY task_id", "logs")
def attempts(spark, d):
    return runmetrics.attempts_panel(A.log_lines(spark, d))


@query("""
    SELECT 1 AS stage_no, 'posts' AS stage, count(*) AS n_rows FROM posts
    UNION ALL SELECT 2, 'comments', count(*) FROM comments
    UNION ALL SELECT 3, 'summaries', count(*) FROM summaries
    UNION ALL SELECT 4, 'sentiments', count(*) FROM sentiments
    UNION ALL SELECT 5, 'valid outputs', count(*) FROM joined""",
       "posts", "comments", "summaries", "sentiments", "joined")
def stage_funnel(spark, d):
    return counters.funnel({
        "posts": posts(spark, d), "comments": A.comments(spark, d), "summaries": A.summaries(spark, d),
        "sentiments": sentiments(spark, d), "valid outputs": joined(spark, d)})
