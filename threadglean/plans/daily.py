"""One daily run: ingest, clean, summarise, enrich, validate, report.

Every stage is one plan over all communities. A stage's tests run before the
next stage starts.
"""

from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import functions as F

from threadglean.constants import COMMENTS_PER_POST, COMMUNITIES, POSTS_PER_COMMUNITY
from threadglean.functions.learned import NaiveBayes
from threadglean.functions.text import mask_pattern
from threadglean.operators import (
    analysis, counters, enrich, increments, ingest, quality, report, scale, summary, watermark)
from threadglean.operators.merge import flag_processed, rows_to_insert
from threadglean.operators.suites import SUITES
from threadglean.schemas import KEYS, TABLES
from threadglean.sources.files import clean_report_lines, write_markdown
from threadglean.sources.tables import Tables


def _stage(method):
    """A stage of the run; the copies it stores go when it ends."""

    @wraps(method)
    def run(*args, **kwargs):
        with scale.stored_copies():
            return method(*args, **kwargs)

    return run


def _time(mark):
    return datetime.fromtimestamp(mark, timezone.utc)


@dataclass
class DailyRun:
    """State and settings of a run. `counts` collects the rows each stage wrote.

    The caps are those of one listing; None lifts them. `harmful` names what the report
    skips: a frame of comment_ids, a pattern of words or a trained NaiveBayes. `check_keys` refuses an append
    whose keys are null, repeated or stored. `gate_by` ("subreddit") tests
    each community apart. A batch is tested when it is added; its results are stored, and a
    gate reads these.
    """

    tables: Tables
    run_ts: object
    lexicon: tuple = ()
    window_mode: str = "faithful"
    summarizer: object = None
    classifier: object = None
    posts_per_community: int | None = POSTS_PER_COMMUNITY
    comments_per_post: int | None = COMMENTS_PER_POST
    harmful: object = None
    check_keys: bool = True
    gate_by: str | None = None
    counts: dict = field(default_factory=dict)

    def gate(self, stage, tables=(), frames=None):
        """Raise if a test of error severity failed: those of what this run has added to
        `tables`, tested when it was added, and those of whole `frames` by name."""
        reports = [self.results().where(F.col("table_name").isin(list(tables)))]
        if frames:
            report_ = quality.run_suites(frames, SUITES, {t: k[-1] for t, k in KEYS.items()}, by=self.gate_by)
            reports.append(report_ if self.gate_by else report_.withColumn("subreddit", F.lit(None).cast("string")))
        return quality.assert_quality(reports[0].unionByName(reports[1]) if frames else reports[0], stage)

    def results(self, all_runs=False):
        """Test results of what this run has added (of all runs: of whole tables), from the
        stored results of batches; no table is read for that."""
        stored = self.tables.read("test_results")
        if not all_runs:
            now = F.lit(self.run_ts).cast("timestamp")
            stored = self.tables.read("test_results", where=F.col("run_day") == F.to_date(now)).where(
                F.col("run_ts") == now)
        return increments.merge_results([stored.drop("run_ts")], by="subreddit")

    def _test(self, name, batch, stored=None):
        """Test a batch once and keep the results. `stored` are the rows before it. The results
        are stored first: after a crash in between, a batch is tested again rather than never."""
        by = self.gate_by if self.gate_by in batch.columns else None
        found = increments.batch_results(batch, name, SUITES[name], stored, KEYS[name][-1], by)
        if not by:
            found = found.withColumn("subreddit", F.lit(None).cast("string"))
        self.tables.append("test_results", found.withColumn("run_ts", F.lit(self.run_ts).cast("timestamp")))

    def _run_time(self):
        """The run's time as the session's timestamps are collected."""
        return self.tables.spark.sql("SELECT CAST(:ts AS TIMESTAMP) AS t", {"ts": self.run_ts}).first()["t"]

    def _lowest_mark(self, marks):
        """Time before which no community has unread rows; None if one has no mark yet."""
        known = {r["subreddit"]: r["mark"] for r in marks.where(F.col("subreddit").isin(COMMUNITIES)).collect()}
        return _time(min(known.values())) if len(known) == len(COMMUNITIES) else None

    def _stored(self, name, batch, keys=None):
        """The stored rows that can meet a row of the batch."""
        return scale.narrow_to(self.tables.read(name), batch, keys or KEYS[name])

    def _append(self, name, df):
        """Append and count in the same job; an empty batch writes nothing."""
        rows = scale.cut_lineage(df)
        if rows.isEmpty():
            self.counts[name] = 0
            return
        if name in SUITES:
            self._test(name, rows, self.tables.read(name))
        rows, seen = counters.observed(rows, name)
        self.tables.append(name, rows, check_key=self.check_keys)
        self.counts[name] = seen.get["rows"]

    def _replace(self, name, df):
        """A new version; of the older ones the last stays, for readers that hold it."""
        self.tables.replace(name, df)
        self.tables.drop_old_versions(name)

    def _open_days(self):
        """Run days that may hold unprocessed rows; None where no day was noted yet."""
        if self.tables.path("open_run_days") is None:
            return None
        return [r["run_day"] for r in self.tables.read("open_run_days").collect()]

    def _open_summaries(self):
        """The summary rows of open run days: only their folders are read."""
        days = self._open_days()
        where = None if days is None else F.col("processed_day").isin(days) if days else F.lit(False)
        return self.tables.read("daily_summary_data", where=where)

    def staged(self):
        return analysis.staging(self._open_summaries())

    # -- stages -------------------------------------------------------------------

    @_stage
    def ingest(self, listing, by=()):
        """Listing entries (schemas.LANDING) to raw posts; moves the source marks.

        Columns `by` tell several listings apart: each has its own cap, and the marks move
        after all of them. A post in several listings is taken from the first.
        """
        t = self.tables
        marks = t.read("processing_metadata")
        entries = ingest.capped_listing(
            ingest.allowed_communities(listing), marks.withColumn("mark", F.col("last_processed_utc").cast("double")),
            self.posts_per_community, by=by)
        if by:
            entries = scale.first_per_key(entries, ["post_id"], [F.asc(c) for c in (*by, "position")])
        mark = F.coalesce("mark", F.lit(0.0))
        entries = entries.withColumn(
            "comments", ingest.capped_comments("comments", mark, self.comments_per_post))
        raw = scale.cut_lineage(ingest.to_raw_posts(entries.drop("mark", "position", *by)))
        self._append("raw_posts", rows_to_insert(
            self._stored("raw_posts", raw), raw, ["post_id"], [F.asc("created_utc"), F.asc("comments")]))
        self._replace("processing_metadata", watermark.advance_marks(marks, raw, self.run_ts))

    @_stage
    def preprocess(self):
        """New raw posts to clean posts and comments.

        The stored posts are the mark that says what was read, so they are written last:
        after a failure between the writes the same raw posts are read again, and comments
        that are stored already are left out by their key.
        """
        t = self.tables
        pattern = mask_pattern(self.lexicon)
        marks = watermark.high_water_marks(t.read_last("posts"))
        raw = watermark.new_rows_by_mark(t.read("raw_posts", self._lowest_mark(marks)), marks)
        posts = ingest.clean_posts(raw, pattern, [F.asc("post_id")])
        comments = ingest.clean_comments(raw, pattern, "subreddit",
                                         order=[F.asc("post_id"), F.asc("created_utc")])
        # Both batches are fixed before the marks move.
        posts, comments = scale.cut_lineage(posts), scale.cut_lineage(comments)
        self._append("comments", rows_to_insert(
            self._stored("comments", comments), comments, ["comment_id"], unique=True))
        self._append("posts", posts)

    @_stage
    def summarise_day(self):
        """New (post, comment) rows to the daily summary table."""
        t = self.tables
        stored, latest = t.read("daily_summary_data"), t.read_last("daily_summary_data")
        last_run = watermark.last_run_mark(latest).first()["mark"]
        if self.window_mode == "event_time":
            marks = [watermark.high_water_mark(t.read(name).join(stored, key, "left_semi")).first()["mark"]
                     for name, key in (("posts", "post_id"), ("comments", "comment_id"))]
            last = tuple(_time(mark) for mark in marks)
        else:
            last = (last_run, last_run)
        posts, comments = summary.in_run_window(
            t.read("posts", last[0]), t.read("comments", last[1]),
            last if self.window_mode == "event_time" else last[0], self.run_ts, self.window_mode)
        rows = scale.cut_lineage(summary.posts_with_comments(posts, comments, self.run_ts))
        fresh = summary.unseen(rows, self._stored("daily_summary_data", rows))
        # Ids grow with the runs, unless this one is set back in time.
        numbered = latest if last_run is None or self._run_time() >= last_run else stored
        today = self.tables.spark.sql("SELECT CAST(:ts AS DATE) AS run_day", {"ts": self.run_ts})
        self._replace("open_run_days", t.read("open_run_days").unionByName(today).distinct())
        self._append("daily_summary_data", summary.with_defaults(fresh, numbered))
        added = t.read_last("daily_summary_data").where(F.col("processed_date") == F.lit(self.run_ts))
        self.counts["new_by_community"] = {
            r["subreddit"]: r["n_rows"] for r in summary.counts_by_community(added).collect()}

    @_stage
    def enrich(self):
        """Summaries and sentiments of the staged comments. Returns failed rows per model."""
        t = self.tables
        # A comment under several posts is worked on once; its last row counts.
        staged = scale.first_per_key(self.staged(), ["comment_id"], [F.desc("id")])
        summaries = scale.cut_lineage(enrich.summarize(staged, self.summarizer))
        sentiments = scale.cut_lineage(enrich.classify(staged, self.classifier))
        for name, df in (("text_summary_results", summaries), ("sentiment_analysis_results", sentiments)):
            self._test(name, df.select(*TABLES[name].names))
        t.upsert("text_summary_results", summaries, [F.asc("comment_summary")])
        t.upsert("sentiment_analysis_results", sentiments, [F.desc("sentiment_score"), F.asc("sentiment_label")])
        return {name: df.where(F.col("error").isNotNull()).count()
                for name, df in (("summarize", summaries), ("classify", sentiments))}

    @_stage
    def analyse(self):
        """Join and validate, then mark the staged rows as processed."""
        t = self.tables
        staged = self.staged()
        self._replace("joined_summary_analysis", analysis.joined_analysis(
            staged, self._stored("text_summary_results", staged),
            self._stored("sentiment_analysis_results", staged), self.run_ts))
        self._append("update_processing_status", rows_to_insert(
            self._stored("update_processing_status", staged), staged.select("comment_id", "post_id"),
            KEYS["update_processing_status"]))
        # Only open days can change.
        unsettled = F.coalesce("needs_processing", F.lit(True))
        touched = self._open_summaries()
        history = self._stored("update_processing_status", touched.where(unsettled), ["comment_id"])
        t.replace_partitions("daily_summary_data", flag_processed(touched, history))
        still = self._open_summaries().where(unsettled).select(F.to_date("processed_date").alias("run_day"))
        self._replace("open_run_days", scale.cut_lineage(still.distinct()))

    def _report_rows(self):
        """The rows of the report; harmful items hold the skip message as their summary."""
        rows = report.report_scan(self.tables.read("joined_summary_analysis"))
        if self.harmful is None:
            return rows
        if isinstance(self.harmful, NaiveBayes):
            flagged = rows.withColumn("harmful", self.harmful.flags("comment_body"))
        elif isinstance(self.harmful, str):
            flagged = report.harmful_by_words(rows, self.harmful)
        else:
            flagged = report.flag_harmful(rows, self.harmful)
        return report.skip_harmful(flagged).drop("harmful")

    @_stage
    def report(self, root):
        lines = report.report_lines(self._report_rows(), self.run_ts)
        write_markdown(clean_report_lines(lines, "text"), root, self.run_ts)

    def prompts(self, header="", model=None, outputs=None, blocks_per_part=500):
        """The prompt text of each community in ordered parts, each behind `header` (a text or
        a column over subreddit). With `model` (see enrich.apply_model) also its `outputs`."""
        parts = report.prompt_parts(
            report.text_blocks(self._report_rows()), blocks_per_part, header)
        return parts if model is None else enrich.apply_model(parts, "text", model, outputs, "prompt")


def run_day(spark, root, listing, run_ts, report_root, **settings):
    """All stages in order, each behind the tests of the one before. Returns the run."""
    run = DailyRun(Tables(spark, root), run_ts, **settings)
    run.ingest(listing)
    run.preprocess()
    run.gate("raw", ["raw_posts", "posts", "comments"])
    run.summarise_day()
    run.gate("staging", ["daily_summary_data"], {"current_summary_staging": run.staged()})
    run.counts["failed"] = run.enrich()
    run.gate("models", ["text_summary_results", "sentiment_analysis_results"])
    run.analyse()
    run.gate("joined", ["update_processing_status"], {
        "joined_summary_analysis": run.tables.read("joined_summary_analysis")})
    run.report(report_root)
    return run

