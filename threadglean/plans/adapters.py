"""The library's table shapes, derived by Spark from the given test tables.

Each adapter has an SQL twin in `ORACLE_TABLES`, used by the comparison queries.
Nulls, blanks and copies are injected by key arithmetic, the same on both sides.
"""

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import summarize_text
from threadglean.operators import scale

# Words to mask: some are frequent in the texts, two are on the never-mask list.
LEXICON = ["with", "the", "that", "der", "les", "que", "tion", "for", "from"]
# Words with capitals and other letters, as they occur in the texts.
FOREIGN_LEXICON = ["Èier", "Éch", "Ère", "éque", "ñ", "Ä", "Und", "LES", "que"]
# Cue words for the built-in classifier, frequent in the texts.
CUES = {
    "joy": ["with", "avec"], "anger": ["that", "nicht"], "curiosity": ["was", "que"],
    "fear": ["this", "los"], "love": ["on", "une"], "sadness": ["by", "und"],
    "desire": ["are", "las"],
}
EPOCH = "TIMESTAMP '2025-01-01 00:00:00'"
RUN_TS = "2026-12-31 00:00:00"


SCHEMAS = {
    "pages": "page_id BIGINT, url STRING, html STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def read(spark, sf_dir, name):
    """A test table by its declared schema, so no footer is read to infer it."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _minutes(n):
    return F.expr(f"timestampadd(MINUTE, CAST({n} AS INT), {EPOCH})")


def _pick(values, index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def raw_posts(spark, sf_dir):
    """Listing rows from pages; every tenth page occurs twice."""
    pid = F.col("page_id")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    copies = F.when(pid % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        read(spark, sf_dir, "pages")
        .withColumn("copy", F.explode(copies))
        .select(
            F.concat(F.lit("p"), pid.cast("string")).alias("post_id"),
            _pick(K.COMMUNITIES, pid % 8).alias("subreddit"),
            F.when(pid % 23 == 0, None).when(pid % 19 == 0, "").when(pid % 17 == 0, K.DELETED)
            .otherwise(title).alias("title"),
            F.when(pid % 13 == 0, K.DELETED)
            .otherwise(F.concat(F.lit("user"), (pid % 97).cast("string"))).alias("author"),
            "url",
            ((pid * 7919) % 2000).cast("int").alias("score"),
            _minutes("page_id * 37").alias("created_utc"),
            ((pid * 104729) % 1000003).alias("position"),
        )
    )


def comments(spark, sf_dir):
    """One comment per document, spread over the posts."""
    did = F.col("doc_id")
    pages = read(spark, sf_dir, "pages").agg(F.count("*")).scalar()
    return read(spark, sf_dir, "documents").select(
        F.concat(F.lit("c"), did.cast("string")).alias("comment_id"),
        F.concat(F.lit("p"), (did % pages).cast("string")).alias("post_id"),
        F.when(did % 41 == 0, None).when(did % 47 == 0, "x").otherwise(F.col("text")).alias("body"),
        F.concat(F.lit("user"), (did % 89).cast("string")).alias("author"),
        _minutes("doc_id * 61").alias("created_utc"),
    )


def raw_threads(spark, sf_dir):
    """Raw rows with a comments array: a document's lines are its comments. Empty
    lines stand for hidden comments that were not loaded (null body)."""
    did = F.col("doc_id")
    base = _minutes("doc_id * 61").cast("double")
    entries = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.when(line != "", line).alias("body"),
            F.concat(F.lit("user"), (i % 7).cast("string")).alias("author"),
            F.concat(F.lit("d"), did.cast("string"), F.lit("_"), i.cast("string")).alias("comment_id"),
            (base + ((i * 37) % 11) * 86400).alias("created_utc"),
        ))
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return scale.spread_small(documents).select(
        F.concat(F.lit("d"), did.cast("string")).alias("post_id"),
        _pick(K.COMMUNITIES, did % 8).alias("subreddit"),
        F.lit("title").alias("title"), F.lit("author").alias("author"), F.col("source").alias("url"),
        (did % 100).cast("int").alias("score"), base.alias("created_utc"),
        ((did * 104729) % 1000003).alias("position"), entries.alias("comments"),
    )


def summaries(spark, sf_dir):
    """The built-in summary of each text; some are missing, blank or longer than the text."""
    did, text = F.col("doc_id"), F.col("text")
    return read(spark, sf_dir, "documents").where(did % 7 != 0).select(
        F.concat(F.lit("c"), did.cast("string")).alias("comment_id"),
        F.when(did % 11 == 0, " ").when(did % 29 == 0, F.concat(text, F.lit(" extra")))
        .otherwise(summarize_text(text)).alias("comment_summary"))


def emotions(spark, sf_dir):
    did = F.col("doc_id")
    return read(spark, sf_dir, "documents").where(did % 5 != 3).select(
        F.concat(F.lit("c"), did.cast("string")).alias("comment_id"),
        ((did % 101) / 100).alias("score"),
        _pick(K.EMOTIONS, did % 28).alias("emotion"))


def harmful_ids(spark, sf_dir):
    return read(spark, sf_dir, "labels").where("toxic = 1").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"))


def log_lines(spark, sf_dir):
    """Task-log lines from events: the kind of task from the user, the marker from
    the event type, hours as runs."""
    task = _pick(TASKS, F.col("user_id") % len(TASKS))
    text = F.lit("INFO - nothing")
    for name, markers in LOG_MARKERS.items():
        for event_type, marker in markers.items():
            text = F.when((task == name) & (F.col("event_type") == event_type), marker).otherwise(text)
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    plain = F.date_format("ts", "yyyy-MM-dd, HH:mm:ss")
    head = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("["), plain, F.lit(" UTC]"))).otherwise(
        F.concat(F.lit("["), stamp, F.lit("+0000]")))
    return read(spark, sf_dir, "events").select(
        F.lit("daily").alias("dag_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        task.alias("task_id"),
        (F.col("user_id") % 3 + 1).cast("int").alias("attempt"),
        F.col("event_id").alias("line_no"),
        F.concat(head, F.lit(" {task.py:1} "),
                 F.regexp_replace(text, "#", F.col("event_id").cast("string")),
                 F.lit(" "), F.col("value").cast("string"), F.lit("s")).alias("value"),
        "ts", "event_type", F.col("value").alias("seconds"),
    )


TASKS = ["ingest_preprocess", "summarize", "sentiment", "tests", "join", "report", "processing_status"]
LOG_MARKERS = {
    "ingest_preprocess": {
        "view": "Starting attempt", "click": "Successfully processed post #",
        "signup": "Processing complete. Total new summaries added: #",
        "purchase": "Task exited with return code 0"},
    "summarize": {
        "view": "Summarization model loaded", "click": "Summary added for comment_id: c#",
        "signup": "Comment is less than the max length", "purchase": "Database connection closed"},
    "sentiment": {
        "view": "Emotion analysis model loaded", "click": "Sentiment analysis added for comment_id: c#",
        "purchase": "Database connection closed"},
    "tests": {
        "view": "Running with dbt", "click": "PASS not_null_#", "signup": "FAIL 1 unique_#",
        "purchase": "Completed successfully"},
    "join": {"click": "Finished running 1 table model in", "purchase": "Completed successfully"},
    "report": {"view": "Analyzing data for subreddit: x", "click": "Output saved to f#.md"},
    "processing_status": {
        "click": "Finished running 1 incremental model in", "purchase": "Completed successfully"},
}


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _log_text():
    arms = [f"WHEN task_id = '{t}' AND event_type = '{e}' THEN '{m}'"
            for t, markers in LOG_MARKERS.items() for e, m in markers.items()]
    return f"CASE {' '.join(arms)} ELSE 'INFO - nothing' END"


SQL_WORDS = r"len(regexp_extract_all({c}, '\S+'))"
_LEAD = r"regexp_extract({c}, '^\s*((?:\S+\s+){{0,59}}\S+)', 1)"


def sql_summary(c):
    """The built-in summary in SQL."""
    lead = _LEAD.format(c=c)
    ended = f"regexp_extract({lead}, '(?s)^(.*[.?!])', 1)"
    return f"""CASE WHEN {c} IS NULL OR {c} = '' THEN '' WHEN {SQL_WORDS.format(c=c)} <= 59 THEN {c}
        WHEN {SQL_WORDS.format(c=ended)} >= 15 THEN {ended} ELSE {lead} END"""


# name -> (SQL, names of the tables it reads)
ORACLE_TABLES = {
    "raw": (f"""
        SELECT 'p' || page_id AS post_id, {_list(K.COMMUNITIES)}[page_id % 8 + 1] AS subreddit,
               CASE WHEN page_id % 23 = 0 THEN NULL WHEN page_id % 19 = 0 THEN ''
                    WHEN page_id % 17 = 0 THEN '[deleted]'
                    ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title,
               CASE WHEN page_id % 13 = 0 THEN '[deleted]' ELSE 'user' || (page_id % 97) END AS author,
               url, CAST((page_id * 7919) % 2000 AS INTEGER) AS score,
               {EPOCH} + to_minutes(CAST(page_id * 37 AS BIGINT)) AS created_utc,
               (page_id * 104729) % 1000003 AS position
        FROM (SELECT * FROM pages UNION ALL SELECT * FROM pages WHERE page_id % 10 = 0)""", ()),
    "valid": ("""
        SELECT * FROM raw
        WHERE title IS NOT NULL AND title <> '' AND title <> '[deleted]'
          AND author IS NOT NULL AND author <> '' AND author <> '[deleted]'""", ("raw",)),
    "posts": ("""
        SELECT DISTINCT post_id, subreddit, title, author, url, score, created_utc FROM valid""",
              ("valid",)),
    "comments": (f"""
        SELECT 'c' || doc_id AS comment_id, 'p' || (doc_id % (SELECT count(*) FROM pages)) AS post_id,
               CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 47 = 0 THEN 'x' ELSE text END AS body,
               'user' || (doc_id % 89) AS author,
               {EPOCH} + to_minutes(CAST(doc_id * 61 AS BIGINT)) AS created_utc
        FROM documents""", ()),
    "threads": (f"""
        SELECT doc_id, 'd' || doc_id AS post_id, {_list(K.COMMUNITIES)}[doc_id % 8 + 1] AS subreddit,
               i - 1 AS i, CASE WHEN line <> '' THEN line END AS body, 'user' || ((i - 1) % 7) AS author,
               'd' || doc_id || '_' || (i - 1) AS comment_id,
               epoch({EPOCH}) + doc_id * 3660 AS posted,
               epoch({EPOCH}) + doc_id * 3660 + (((i - 1) * 37) % 11) * 86400 AS created
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""", ()),
    "daily": ("""
        SELECT subreddit, p.post_id, score AS post_score, url AS post_url, comment_id,
               CAST(c.created_utc AS DATE) AS summary_date, title AS post_content, body AS comment_body
        FROM comments c JOIN posts p ON c.post_id = p.post_id
        WHERE body IS NOT NULL AND comment_id IS NOT NULL""", ("posts", "comments")),
    "summaries": (f"""
        SELECT 'c' || doc_id AS comment_id,
               CASE WHEN doc_id % 11 = 0 THEN ' ' WHEN doc_id % 29 = 0 THEN text || ' extra'
                    ELSE {sql_summary('text')} END AS comment_summary
        FROM documents WHERE doc_id % 7 <> 0""", ()),
    "emotions": (f"""
        SELECT 'c' || doc_id AS comment_id, (doc_id % 101) / 100 AS score,
               {_list(K.EMOTIONS)}[doc_id % 28 + 1] AS emotion
        FROM documents WHERE doc_id % 5 <> 3""", ()),
    "mapping": ("SELECT * FROM (VALUES " + ", ".join(
        f"('{e}', '{s}')" for e, s in K.EMOTION_SENTIMENT.items()) + ") t(emotion, sentiment)", ()),
    "sentiments": ("""
        SELECT comment_id, score AS sentiment_score, coalesce(sentiment, 'Neutral') AS sentiment_label
        FROM emotions LEFT JOIN mapping ON emotions.emotion = mapping.emotion""",
                   ("emotions", "mapping")),
    "checked": ("""
        SELECT d.*, comment_summary, sentiment_score, sentiment_label,
               CASE WHEN length(comment_body) < 2 THEN 'Too short'
                    WHEN length(comment_body) > 10000 THEN 'Too long' ELSE 'Valid' END AS comment_quality,
               CASE WHEN comment_summary IS NULL OR trim(comment_summary) = '' THEN 'Missing'
                    WHEN length(comment_summary) > length(comment_body) THEN 'Invalid'
                    ELSE 'Valid' END AS summary_quality
        FROM daily d LEFT JOIN summaries s ON d.comment_id = s.comment_id
        LEFT JOIN sentiments a ON d.comment_id = a.comment_id""", ("daily", "summaries", "sentiments")),
    "joined": ("""
        SELECT * FROM checked WHERE comment_quality = 'Valid' AND summary_quality = 'Valid'""",
               ("checked",)),
    "harmful": ("SELECT 'c' || doc_id AS comment_id FROM labels WHERE toxic = 1", ()),
    "logs": (f"""
        SELECT *, CASE WHEN event_id % 5 = 0 THEN date_trunc('second', ts)
                       ELSE date_trunc('millisecond', ts) END AS logged,
               {_log_text()} AS marker
        FROM (SELECT *, 'daily' AS dag_id, strftime(ts, '%Y-%m-%d') AS run_id,
                     {_list(TASKS)}[user_id % {len(TASKS)} + 1] AS task_id,
                     CAST(user_id % 3 + 1 AS INTEGER) AS attempt FROM events)""", ()),
}


def oracle(select, *tables):
    """`select` behind the WITH clause of the tables it uses and all they read."""
    order = []

    def visit(name):
        for needed in ORACLE_TABLES[name][1]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in tables:
        visit(name)
    if not order:
        return select
    ctes = ",\n".join(f"{n} AS ({ORACLE_TABLES[n][0]})" for n in order)
    own = select.strip()
    if own.startswith("WITH "):
        return f"WITH {ctes},\n{own[5:]}"
    return f"WITH {ctes}\n{own}"
