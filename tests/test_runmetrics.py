import datetime as dt

import pytest

from threadglean.operators import runmetrics as R
from threadglean.sources.files import read_task_logs

ISO = "[2025-01-09T22:00:{:02d}.{:03d}+0000] {{x.py:1}} INFO - {}"


def at(second, text, milli=0):
    return ISO.format(second, milli, text)


def metrics(spark, kind, lines, attempt=1):
    df = spark.createDataFrame(
        [("d", "r", kind, attempt, i, line) for i, line in enumerate(lines)],
        "dag_id string, run_id string, task_id string, attempt int, line_no long, value string")
    return R.extract_metrics(df, R.EXTRACTORS[kind]).first()


def test_ingest(spark):
    m = metrics(spark, "ingest_preprocess", [
        at(1, "Starting attempt 1 of 2"), at(2, "Starting attempt 2 of 2"),
        at(3, "Successfully processed post a"), at(4, "Successfully processed post b"),
        at(5, "Processing complete. Total new summaries added: 7"),
        at(6, "Processing complete. Total new summaries added: 9"),
        at(12, "Task exited with return code 0", 500)], attempt=2)
    assert (m.processed_posts, m.total_summaries, m.success, m.next_attempt) == (2, 9, True, 1)
    assert m.duration_seconds == 10.5  # from the last start


def test_summarize_counts_short_comments_twice(spark):
    m = metrics(spark, "summarize", [
        "[2025-01-09, 22:00:01 UTC] Summarization model loaded",
        "Comment is less than the max length", "Summary added for comment_id: c1",
        "Summary added for comment_id: c2", at(31, "Database connection closed")])
    assert (m.summaries_added, m.short_comments, m.total_processed) == (2, 1, 3)
    assert (m.duration_seconds, m.success) == (30.0, True)


def test_first_marker_takes_the_line(spark):
    m = metrics(spark, "summarize", [
        at(1, "Summarization model loaded"),
        at(2, "Summary added for comment_id: Comment is less than the max length"),
        "Database connection closed without a time"], attempt=3)
    assert (m.summaries_added, m.short_comments) == (1, 0)
    assert (m.success, m.next_attempt, m.duration_seconds) == (False, 4, None)


def test_tests_and_series(spark):
    m = metrics(spark, "tests", [at(1, "Running with dbt"), "PASS a", "PASS b", "FAIL c", "PASS and FAIL",
                                 at(3, "Completed successfully")])
    assert (m.tests_passed, m.tests_failed, m.tests_total) == (3, 1, 4)
    df = spark.createDataFrame([m.asDict()], "dag_id string, run_id string, task_id string, attempt int, "
                               "tests_passed long, tests_failed long, tests_total long, success boolean, "
                               "error boolean, duration_seconds double, next_attempt int")
    got = {r.metric: (r.kind, r.value) for r in R.metric_series(df, "dbt.tests").collect()}
    assert got["dbt.tests.tests.passed"] == ("gauge", 3.0)
    assert got["dbt.tests.duration"] == ("timing", 2000.0)
    assert got["dbt.tests.success"] == ("counter", 1.0)
    assert len(got) == 6
    series = R.metric_series(df, "dbt.test_raw_sources")
    names = {r.name: r.value for r in R.export_names(series, prefix="x_").collect()}
    assert names == {"x_dbt_raw_sources_tests_passed": 3.0, "x_dbt_raw_sources_tests_failed": 1.0}


def test_printed_seconds(spark):
    for kind, word in (("join", "table"), ("processing_status", "incremental")):
        m = metrics(spark, kind, [f"Finished running 1 {word} model in 0 hours and 1.25 seconds (1.25s).",
                                  "Completed successfully"])
        assert (m.duration_seconds, m.success) == (1.25, True)


def test_report_runs_from_first_marker_to_last_time(spark):
    m = metrics(spark, "report", [
        at(1, "Model loaded"), at(2, "Analyzing data for subreddit: a"), at(3, "Output saved to a"),
        at(4, "Analyzing data for subreddit: b"), at(9, "done")])
    assert (m.subreddits_processed, m.outputs_generated, m.success) == (2, 1, False)
    assert m.duration_seconds == 7.0


def test_unreadable_times(spark):
    m = metrics(spark, "sentiment", ["[yesterday] Emotion analysis model loaded", at(2, "Database connection closed")])
    assert (m.error, m.duration_seconds) == (True, None)
    m = metrics(spark, "report", [at(1, "Analyzing data for subreddit: a"), "[odd] Output saved to a"])
    assert (m.error, m.success) == (True, True)
    m = metrics(spark, "report", ["[odd] Model loaded"])
    assert (m.error, m.success) == (False, True)  # nothing to do and nothing done


def test_log_files(spark, tmp_path):
    folder = tmp_path / "dag_id=d/run_id=scheduled__2025-01-09T22:00:00+00:00/task_id=summarize"
    folder.mkdir(parents=True)
    (folder / "attempt=1.log").write_text(at(1, "Summarization model loaded") + "\n")
    text = "\n".join([at(1, "Summarization model loaded"), *["Summary added for comment_id: c"] * 3000,
                      at(5, "Summarization model loaded"), at(8, "Database connection closed")])
    (folder / "attempt=2.log").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")  # several splits per file
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        lines = read_task_logs(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = {r.attempt: r for r in R.extract_metrics(lines, R.EXTRACTORS["summarize"]).collect()}
        ordered = [r.value for r in lines.where("attempt = 2").orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert ordered == text.split("\n")
    assert (got[1].success, got[1].next_attempt) == (False, 2)
    assert (got[2].summaries_added, got[2].duration_seconds, got[2].success) == (3000, 3.0, True)
    assert got[2].run_id.startswith("scheduled__2025-01-09")


def test_dashboards(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 10.1), ("a", 5000.0), ("b", 1.0)],
                               "task_id string, duration_seconds double")
    got = {(r.task_id, r.le): r.n for r in R.duration_histogram(df).collect()}
    assert (got[("a", "10")], got[("a", "30")], got[("a", "1800")], got[("a", "+Inf")]) == (1, 2, 2, 3)
    assert dict(R.duration_minutes(df).collect())["b"] == pytest.approx(1 / 60)
    t = dt.datetime(2025, 1, 9, 22, 4)
    errors = spark.createDataFrame([("a", t), ("a", t), ("a", t + dt.timedelta(minutes=1))],
                                   "task_id string, ts timestamp")
    got = sorted((r.window_start.minute, r.errors_per_second) for r in R.error_rate(errors).collect())
    assert got == [(0, 2 / 300), (5, 1 / 300)]


def test_no_timing_without_a_measured_duration(spark):
    for kind, lines, timed in (("summarize", [at(1, "Summarization model loaded")], False),
                               ("join", ["Completed successfully"], False),
                               ("report", [at(1, "Analyzing data for subreddit: a")], True)):
        logs = spark.createDataFrame([("d", "r", kind, 1, i, v) for i, v in enumerate(lines)],
                                     "dag_id string, run_id string, task_id string, attempt int, line_no long, value string")
        series = R.all_series(R.run_metrics(logs, {kind: [kind]}))
        assert (series.where("kind = 'timing'").count() > 0) == timed
        assert series.where("kind = 'counter'").count() == 1


def test_chain_from_log_files_to_exported_points(spark, tmp_path):
    """Files, metrics of all kinds, exported names, histogram and minutes."""
    logs = {
        "ingest": [at(1, "Starting attempt"), at(3, "Successfully processed post a"), at(4, "Task exited with return code 0")],
        "summarize": [at(1, "Summarization model loaded"), "Summary added for comment_id: c1",
                      at(41, "Database connection closed")],
        "sentiment": [at(1, "Emotion analysis model loaded")],
        "test_raw_sources": [at(1, "Running with dbt"), "PASS a", at(2, "Completed successfully")],
        "join": ["Finished running 1 table model in 0 hours (61.50s).", "Completed successfully"],
        "status": ["Finished running 1 incremental model in 0 hours (1.25s).", "Completed successfully"],
        "report": [at(1, "Analyzing data for subreddit: a"), at(9, "Output saved to a")]}
    for task, lines in logs.items():
        folder = tmp_path / f"dag_id=d/run_id=r1/task_id={task}"
        folder.mkdir(parents=True)
        (folder / "attempt=1.log").write_text("\n".join(lines))
    kinds = {"ingest_preprocess": ["ingest"], "summarize": ["summarize"], "sentiment": ["sentiment"],
             "tests": ["test_raw_sources"], "join": ["join"], "processing_status": ["status"], "report": ["report"]}
    tables = {"join": spark.range(12), "processing_status": spark.range(34)}
    found = R.run_metrics(read_task_logs(spark, str(tmp_path)), kinds, tables)
    points = {r.name: r.value for r in R.export_names(R.all_series(found)).collect()}
    assert points["ingest_preprocess_duration_seconds"] == 3000 and points["join_model_duration_seconds"] == 61500
    assert points["joined_table_rows"] == 12 and points["processing_status_rows"] == 34
    assert points["dbt_raw_sources_tests_passed"] == 1 and points["sentiment_retry_total"] == 1
    assert "sentiment_duration_seconds" not in points and points["gemini_duration"] == 8000
    durations = None
    for frame in found.values():
        part = frame.select("task_id", "duration_seconds")
        durations = part if durations is None else durations.unionByName(part)
    counts = {(r.task_id, r.le): r.n for r in R.duration_histogram(durations).collect()}
    assert counts["summarize", "30"] == 0 and counts["summarize", "60"] == 1 and counts["sentiment", "+Inf"] == 0
    minutes = dict(R.duration_minutes(durations).collect())
    assert minutes["join"] == pytest.approx(61.5 / 60)


def test_sliding_rate_equals_a_plain_count(spark):
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    rng = random.Random(8)
    begin = dt.datetime(2025, 1, 9, 23, 40, tzinfo=dt.timezone.utc)
    errors = [(rng.choice("ab"), begin + dt.timedelta(seconds=rng.randrange(5400))) for _ in range(40)]
    df = spark.createDataFrame(errors + [("a", None)], "task_id string, ts timestamp")
    got = {(r.task_id, r.end): (r.n_errors, r.errors_per_second) for r in R.sliding_error_rate(df).select(
        "*", F.unix_seconds("window_end").alias("end")).collect()}
    seconds = [(t, ts.timestamp()) for t, ts in errors]
    low = min(s for _, s in seconds) // 60 * 60 + 60
    high = max(s for _, s in seconds) // 60 * 60 + 300
    want = {(t, int(end)): sum(x == t and end - 300 <= s < end for x, s in seconds)
            for t in "ab" for end in range(int(low), int(high) + 1, 60)}
    assert {k: n for k, (n, _) in got.items()} == want
    assert all(rate == n / 300 for n, rate in got.values()) and 0 in want.values()
    assert R.sliding_error_rate(df.limit(0)).count() == 0
