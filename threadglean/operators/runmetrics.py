"""Run metrics from task logs, as grouped aggregates over all logs at once.

Lines are rows dag_id, run_id, task_id, attempt, line_no, value. An extractor is
data: a start marker, an end marker and counted markers. A line counts for the
first marker of the chain that it matches.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Window, functions as F

from threadglean import constants as K

RUN_KEYS = ["dag_id", "run_id", "task_id", "attempt"]


@dataclass(frozen=True)
class Step:
    """One link of a chain: lines with `marker` that no earlier link took.

    Roles: start and end (the line's time), count (lines), number (the last
    number found by `pattern`), seconds (a printed duration found by `pattern`).
    """

    role: str
    marker: str
    metric: str | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class Extractor:
    """`total` is the sum of several counters, `equal` a pair of counters whose
    equality means success. With `first_start` the run goes from the first line
    of the first link to the last bracketed line of any kind."""

    chain: tuple
    total: tuple | None = None
    equal: tuple | None = None
    first_start: bool = False


# --- Fixed values: markers printed by the tasks, metric names ---------------------
EXTRACTORS = {
    "ingest_preprocess": Extractor((
        Step("start", "Starting attempt"),
        Step("end", "Task exited with return code 0"),
        Step("count", "Successfully processed post", "processed_posts"),
        Step("number", "Processing complete. Total new summaries added:", "total_summaries",
             r"Total new summaries added: (\d+)"),
    )),
    "summarize": Extractor((
        Step("start", "Summarization model loaded"),
        Step("count", "Summary added for comment_id:", "summaries_added"),
        Step("count", "Comment is less than the max length", "short_comments"),
        Step("end", "Database connection closed"),
    ), total=("total_processed", ("summaries_added", "short_comments"))),
    "sentiment": Extractor((
        Step("start", "Emotion analysis model loaded"),
        Step("count", "Sentiment analysis added for comment_id:", "processed"),
        Step("end", "Database connection closed"),
    )),
    "tests": Extractor((
        Step("start", "Running with dbt"),
        Step("count", "PASS", "tests_passed"),
        Step("count", "FAIL", "tests_failed"),
        Step("end", "Completed successfully"),
    ), total=("tests_total", ("tests_passed", "tests_failed"))),
    "join": Extractor((
        Step("seconds", "Finished running 1 table model in", pattern=r"(\d+\.\d+)s"),
        Step("end", "Completed successfully"),
    )),
    "processing_status": Extractor((
        Step("seconds", "Finished running 1 incremental model in", pattern=r"(\d+\.\d+)s"),
        Step("end", "Completed successfully"),
    )),
    "report": Extractor((
        Step("count", "Analyzing data for subreddit:", "subreddits_processed"),
        Step("count", "Output saved to", "outputs_generated"),
    ), equal=("outputs_generated", "subreddits_processed"), first_start=True),
}

# --- Fixed values: bracketed time formats of log lines ------------------------------
PLAIN_TIME = "yyyy-MM-dd, HH:mm:ss 'UTC'"
ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSXX"
ISO_TIME_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXX"


def bracket_text(line):
    """Text in the first brackets of a line, null without brackets."""
    found = F.regexp_extract(line, r"\[(.*?)\]", 0)
    return F.when(found != "", F.regexp_extract(line, r"\[(.*?)\]", 1))


def iso_time(text):
    return F.coalesce(F.try_to_timestamp(text, F.lit(ISO_TIME)),
                      F.try_to_timestamp(text, F.lit(ISO_TIME_MICROS)))


def log_time(text):
    """Time of a bracketed text in either of the two formats, else null."""
    text = F.trim(text)
    return F.coalesce(F.try_to_timestamp(text, F.lit(PLAIN_TIME)), iso_time(text))


def _last(value, when):
    """Value on the last line where `when` holds."""
    return F.max_by(F.when(when, value), F.when(when, F.col("line_no")))


def extract_metrics(lines, extractor):
    """One row per attempt: the metrics, success, duration_seconds, next_attempt,
    and `error`: whether a time that is needed could not be read.

    Last and first lines are found by max_by/min_by on the line number, so lines
    are combined before the shuffle and never sorted.
    """
    text = bracket_text(F.col("value"))
    timed = any(step.role == "start" for step in extractor.chain)
    columns, taken, unread = [], F.lit(False), F.lit(False)
    for step in extractor.chain:
        hit = F.col("value").contains(step.marker)
        if timed and step.role in ("start", "end"):
            hit = hit & text.isNotNull()
        mine, taken = hit & ~taken, taken | hit
        if step.role == "count":
            columns.append(F.count_if(mine).alias(step.metric))
        elif step.role in ("number", "seconds"):
            number = F.regexp_extract("value", step.pattern, 1)
            kind, name = (("bigint", step.metric) if step.role == "number"
                          else ("double", "duration_seconds"))
            last = _last(number.try_cast(kind), mine & (number != ""))
            # A count that was not printed is 0; a duration that was not is unknown.
            columns.append((F.coalesce(last, F.lit(0).cast(kind)) if step.role == "number" else last).alias(name))
        elif timed:
            columns.append(_last(log_time(text), mine).alias("__" + step.role))
            unread = unread | (mine & log_time(text).isNull())
        if step.role == "end":
            columns.append((F.count_if(mine) > 0).alias("success"))
    if extractor.first_start:
        begins = F.col("value").contains(extractor.chain[0].marker) & text.isNotNull()
        columns += [
            F.min_by(F.when(begins, iso_time(text)), F.when(begins, F.col("line_no"))).alias("__start"),
            _last(iso_time(text), text.isNotNull()).alias("__end"),
            (F.count_if(begins) > 0).alias("__begun")]
    columns.append((F.count_if(unread) > 0).alias("error"))
    rows = lines.groupBy(*RUN_KEYS).agg(*columns)
    if extractor.first_start:
        lost = F.col("__start").isNull() | F.col("__end").isNull()
        rows = rows.withColumn("error", F.col("__begun") & lost).drop("__begun")
    if timed or extractor.first_start:
        spent = F.col("__end").cast("double") - F.col("__start").cast("double")
        spent = F.round(spent, 6)
        # Only the report task sends a duration in any case.
        spent = F.coalesce(spent, F.lit(0.0)) if extractor.first_start else spent
        rows = rows.withColumn("duration_seconds", spent).drop("__start", "__end")
    if extractor.total:
        name, parts = extractor.total
        rows = rows.withColumn(name, reduce(lambda a, b: a + b, [F.col(p) for p in parts]))
    if extractor.equal:
        left, right = extractor.equal
        rows = rows.withColumn("success", F.col(left) == F.col(right))
    return rows.withColumn(
        "next_attempt", F.when(F.col("success"), 1).otherwise(F.col("attempt") + 1).cast("int"))


def extract_all(lines, kinds):
    """Metrics of several kinds of task, each from its own task_ids:
    kind -> frame. `kinds` maps an extractor name to a list of task_ids."""
    return {kind: extract_metrics(lines.where(F.col("task_id").isin(tasks)), EXTRACTORS[kind])
            for kind, tasks in kinds.items()}


def with_table_rows(metrics, table, name):
    """A metric that is the row count of a result table."""
    return metrics.withColumn(name, table.agg(F.count("*")).scalar())


# --- Fixed values: printed forms of metric names --------------------------------------
METRIC_NAMES = {
    "tests_passed": "tests.passed",
    "tests_failed": "tests.failed",
    "tests_total": "tests.total",
    "attempt": "current_attempt",
    "duration_seconds": "duration",
}


def metric_series(metrics, prefix):
    """Long form: run keys, metric, kind (gauge, counter, timing), value.

    Counts and the attempt are gauges; the outcome is a counter named success or
    retry; the duration is a timing in milliseconds, left out where none was
    measured. An attempt whose log could not be read gives one point, the counter error.
    """
    special = {*RUN_KEYS, "success", "error", "next_attempt", "duration_seconds"}

    def point(name, kind, value):
        metric = F.concat(F.lit(prefix + "."), name)
        return F.struct(metric.alias("metric"), F.lit(kind).alias("kind"),
                        value.cast("double").alias("value"))

    gauges = [c for c in metrics.columns if c not in special] + ["attempt"]
    points = [point(F.lit(METRIC_NAMES.get(c, c)), "gauge", F.col(c)) for c in gauges]
    outcome = F.when(F.col("success"), "success").otherwise("retry")
    points.append(point(outcome, "counter", F.lit(1)))
    points.append(point(F.lit("duration"), "timing", F.col("duration_seconds") * 1000))
    failed = F.array(point(F.lit("error"), "counter", F.lit(1)))
    shown = F.when(F.col("error"), failed).otherwise(F.array(*points))
    return metrics.select(*RUN_KEYS, F.inline(shown)).where(
        (F.col("kind") != "timing") | F.col("value").isNotNull())


# --- Fixed values: metric prefix of each kind of task ----------------------------------
METRIC_PREFIXES = {
    "ingest_preprocess": "ingest_preprocess",
    "summarize": "summarize",
    "sentiment": "sentiment",
    "tests": "dbt",
    "join": "join",
    "processing_status": "processing_status",
    "report": "gemini",
}


def all_series(metrics):
    """The points of all kinds (kind -> metrics frame) as one frame. The tests of a stage
    carry its task_id in their prefix."""
    parts = []
    for kind, frame in metrics.items():
        prefix = METRIC_PREFIXES[kind]
        if kind != "tests":
            parts.append(metric_series(frame, prefix))
            continue
        series = metric_series(frame, "")
        parts.append(series.withColumn(
            "metric", F.concat(F.lit(prefix + "."), "task_id", "metric")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_metrics(lines, kinds, table_rows=None):
    """Metrics of every kind from task-log lines (`sources.files.read_task_logs`).

    `kinds` maps a kind to its task_ids; `table_rows` a kind to the result table whose
    row count belongs to its metrics.
    """
    found = extract_all(lines, kinds)
    for kind, table in (table_rows or {}).items():
        found[kind] = with_table_rows(found[kind], table, "rows_processed")
    return found


# --- Fixed values: exported names of metrics, per task, in declared order --------------
EXPORTED_NAMES = {
    "ingest_preprocess.processed_posts": "ingest_preprocess_posts_total",
    "ingest_preprocess.total_summaries": "ingest_preprocess_summaries_total",
    "ingest_preprocess.current_attempt": "ingest_preprocess_attempt",
    "ingest_preprocess.success": "ingest_preprocess_success_total",
    "ingest_preprocess.retry": "ingest_preprocess_retry_total",
    "ingest_preprocess.error": "ingest_preprocess_error_total",
    "ingest_preprocess.duration": "ingest_preprocess_duration_seconds",
    "summarize.summaries_added": "summarize_summaries_added",
    "summarize.short_comments": "summarize_short_comments",
    "summarize.total_processed": "summarize_total_processed",
    "summarize.current_attempt": "summarize_attempt",
    "summarize.success": "summarize_success_total",
    "summarize.retry": "summarize_retry_total",
    "summarize.error": "summarize_error_total",
    "summarize.duration": "summarize_duration_seconds",
    "sentiment.processed": "sentiment_processed_total",
    "sentiment.current_attempt": "sentiment_attempt",
    "sentiment.success": "sentiment_success_total",
    "sentiment.retry": "sentiment_retry_total",
    "sentiment.error": "sentiment_error_total",
    "sentiment.duration": "sentiment_duration_seconds",
    "join.rows_processed": "joined_table_rows",
    "join.current_attempt": "join_attempt",
    "join.success": "join_success_total",
    "join.retry": "join_retry_total",
    "join.error": "join_error_total",
    "join.duration": "join_model_duration_seconds",
    "processing_status.duration": "processing_status_duration",
    "processing_status.rows_processed": "processing_status_rows",
    "processing_status.current_attempt": "processing_status_attempt",
    "processing_status.success": "processing_status_success_total",
    "processing_status.retry": "processing_status_retry_total",
    "processing_status.error": "processing_status_error_total",
    "gemini.outputs_generated": "gemini_outputs",
    "gemini.subreddits_processed": "gemini_subreddits",
    "gemini.current_attempt": "gemini_attempt",
    "gemini.duration": "gemini_duration",
    "gemini.success": "gemini_success_total",
    "gemini.retry": "gemini_retry_total",
    "gemini.error": "gemini_error_total",
    "dbt.test_raw_sources.tests.passed": "dbt_raw_sources_tests_passed",
    "dbt.test_raw_sources.tests.failed": "dbt_raw_sources_tests_failed",
    "dbt.test_staging_models.tests.passed": "dbt_staging_models_tests_passed",
    "dbt.test_staging_models.tests.failed": "dbt_staging_models_tests_failed",
    "dbt.test_summarize_models.tests.passed": "dbt_summarize_models_tests_passed",
    "dbt.test_summarize_models.tests.failed": "dbt_summarize_models_tests_failed",
    "dbt.test_sentiment_analysis.tests.passed": "dbt_sentiment_analysis_tests_passed",
    "dbt.test_sentiment_analysis.tests.failed": "dbt_sentiment_analysis_tests_failed",
    "dbt.test_joined_summary_analysis.tests.passed": "dbt_joined_summary_analysis_tests_passed",
    "dbt.test_joined_summary_analysis.tests.failed": "dbt_joined_summary_analysis_tests_failed",
    "dbt.test_update_processing_status.tests.passed": "dbt_update_processing_status_tests_passed",
    "dbt.test_update_processing_status.tests.failed": "dbt_update_processing_status_tests_failed",
}


def export_names(series, names=EXPORTED_NAMES, prefix=""):
    """Points whose metric has an exported name, with that name. The name table
    is a literal map, so no join is needed."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    named = series.withColumn("name", F.try_element_at(table, F.col("metric")))
    return named.where(F.col("name").isNotNull()).withColumn("name", F.concat(F.lit(prefix), "name"))


# --- dashboards -----------------------------------------------------------------------

def duration_histogram(durations, by="task_id", value="duration_seconds",
                       bounds=tuple(K.DURATION_BOUNDS_SECONDS)):
    """Cumulative counts per upper bound, the last bound being +Inf."""
    labels = [str(b) for b in bounds] + ["+Inf"]
    counted = durations.groupBy(by).agg(
        *[F.count_if(F.col(value) <= b).alias(str(b)) for b in bounds],
        F.count(value).alias("+Inf"))
    buckets = [F.struct(F.lit(i).alias("bucket_no"), F.lit(le).alias("le"), F.col(f"`{le}`").alias("n"))
               for i, le in enumerate(labels)]
    return counted.select(by, F.inline(F.array(*buckets)))


def duration_minutes(durations, by="task_id", value="duration_seconds"):
    return durations.groupBy(by).agg((F.sum(value) / 60).alias("minutes"))


def error_rate(errors, ts="ts", by="task_id", seconds=K.ERROR_RATE_WINDOW_SECONDS):
    """Errors per second in windows of `seconds`, per task; only windows with errors."""
    return (
        errors.groupBy(by, F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(F.count("*").alias("n_errors"))
        .select(by, F.col("w.start").alias("window_start"), "n_errors",
                (F.col("n_errors") / seconds).alias("errors_per_second"))
    )


def sliding_error_rate(errors, ts="ts", by="task_id", seconds=K.ERROR_RATE_WINDOW_SECONDS, step=60):
    """Errors per second over the last `seconds`, every `step` seconds, per task: from the first
    error of any task until the last one has left the window. Windows without errors have 0.

    Errors are counted per step first; a window then sums steps. A task's steps of one day and the
    window before it are a group, so its whole history is never in one task.
    """
    if seconds % step:
        raise ValueError(f"{seconds} seconds are not whole steps of {step}")
    width = seconds // step
    number = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (step * 1_000_000)) + 1
    counted = errors.where(F.col(ts).isNotNull()).groupBy(by, number.alias("step")).agg(F.count("*").alias("n"))
    span = counted.agg(F.struct(F.min("step").alias("low"), F.max("step").alias("high"))).scalar()
    grid = counted.select(by).distinct().select(
        by, F.explode(F.sequence(span["low"], span["high"] + (width - 1))).alias("step"))
    # Each step stands in the days of all windows it belongs to: its own and maybe the next.
    per_day = 86_400 // step
    filled = grid.join(counted, [by, "step"], "left").select(by, "step", F.coalesce("n", F.lit(0)).alias("n"))
    days = F.array_distinct(F.array(F.floor(F.col("step") / per_day), F.floor((F.col("step") + width - 1) / per_day)))
    spread = filled.withColumn("day", F.explode(days))
    own_day = F.floor(F.col("step") / per_day) == F.col("day")
    window = Window.partitionBy(by, "day").orderBy("step").rowsBetween(1 - width, 0)
    summed = spread.select(by, "step", own_day.alias("own"), F.sum("n").over(window).alias("n_errors")).where("own")
    return summed.select(
        by, F.timestamp_seconds(F.col("step") * step).alias("window_end"), "n_errors",
        (F.col("n_errors") / seconds).alias("errors_per_second"))


def test_result_panel(metrics):
    """Passed and failed tests per test stage."""
    return metrics.groupBy("task_id").agg(
        F.sum("tests_passed").alias("passed"), F.sum("tests_failed").alias("failed"))


def attempts_panel(lines):
    """Highest attempt per task."""
    return lines.groupBy("task_id").agg(F.max("attempt").alias("attempt"))
