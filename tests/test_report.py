import datetime as dt

import pytest
from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.operators import report
from threadglean.sources import files
from tests.helpers import rows

COLUMNS = ("subreddit string, post_id string, post_score int, post_url string, comment_id string, "
           "summary_date date, post_content string, comment_body string, comment_summary string, "
           "sentiment_score double, sentiment_label string")


@pytest.fixture(scope="module")
def joined(spark):
    day = dt.date(2025, 1, 9)
    data = []
    for community, post, score, labels in [
            ("openai", "p1", 10, [("Positive", .9), ("Positive", .8), ("Negative", .2), ("Neutral", None), (None, None)]),
            ("openai", "p2", 30, [("Negative", .5)]),
            ("openai", "p3", 10, [(None, None)]),
            ("other", "p4", 1, [("Neutral", .1), ("Positive", .1)])]:
        for i, (label, value) in enumerate(labels):
            data.append((community, post, score, f"http://x/{post}", f"{post}c{i}", day, f"[D] {post}", "body text",
                         f"view\n{i}", value, label))
    return spark.createDataFrame(data, COLUMNS)


def test_ranking(joined):
    plain = report.rank_threads(joined)
    assert rows(plain.select("subreddit", "thread_rank", "post_id", "n_comments")) == [
        ("openai", 1, "p2", 1), ("openai", 2, "p1", 5), ("openai", 3, "p3", 1), ("other", 1, "p4", 2)]
    assert rows(report.rank_threads(joined, partitions=3, small_limit=0)) == rows(plain)


def test_emotions(joined):
    got = {r.post_id: r for r in report.thread_emotions(joined).collect()}
    assert (got["p1"].dominant, got["p2"].dominant, got["p3"].dominant, got["p4"].dominant) == (
        "Positive", "Negative", "none", "Positive")
    assert (got["p1"].n_labelled, got["p1"].avg_score, got["p1"].min_score) == (4, 0.633333, 0.2)


def test_views(joined):
    got = rows(report.top_views(joined).where("post_id = 'p1'").select("view_no", "comment_id"))
    assert got == [(1, "p1c0"), (2, "p1c2"), (3, "p1c3")]  # one per label before a second Positive
    assert report.top_views(joined).where("post_id = 'p2'").count() == 1


def test_blocks_and_parts(joined):
    blocks = report.text_blocks(joined)
    assert rows(report.text_blocks(joined, partitions=4, small_limit=0)) == rows(blocks)
    ordered = [r.block for r in blocks.where("subreddit = 'openai'").orderBy("row_no").collect()]
    for size in (1, 2, 100):
        parts = report.prompt_parts(blocks, size).where("subreddit = 'openai'").orderBy("part_no").collect()
        assert "".join(p.text for p in parts) == "".join(ordered)
        assert max(p.n_blocks for p in parts) <= size


def test_harmful(spark, joined):
    ids = spark.createDataFrame([("p1c0",), ("p1c0",), ("zz",)], "comment_id string")
    got = report.skip_harmful(report.flag_harmful(joined, ids))
    assert got.count() == joined.count()
    assert rows(got.where("harmful").select("comment_id", "comment_summary")) == [("p1c0", K.HARMFUL_MESSAGE)]
    salted = report.flag_harmful(joined, ids, rows_per_task=1, small_limit=0)
    assert rows(salted) == rows(report.flag_harmful(joined, ids))
    assert report.harmful_by_words(joined, "text$").where("harmful").count() == joined.count()
    assert report.report_scan(joined, "other").count() == 2


def test_report_lines(joined):
    lines = report.report_lines(joined, "2025-01-09")
    text = [r.text for r in lines.where("subreddit = 'openai'")
            .orderBy("section", "position", "line_no").collect()]
    assert text[:8] == [
        "---", 'title: "OpenAI Subreddit"', 'date: "2025-01-09"',
        'description: "Analysis of top discussions and trends in the openai subreddit"',
        'tags: ["openai"]', "---", "# Overall Ranking and Top Discussions",
        "1. [[D] p2](http://x/p2) (Score: 30)"]
    start = text.index("# Detailed Analysis by Thread")
    assert text[start + 1:start + 7] == [
        "**[[D] p2 (Score: 30)](http://x/p2)**", "*  **Summary:** view 0",
        "*  **Emotion:** mostly negative (Positive 0, Negative 1, Neutral 0)",
        "*  **Top 3 Points of View:**", "    * view 0", ""]
    assert rows(report.report_lines(joined, "2025-01-09", partitions=3, small_limit=0)) == rows(lines)


def test_report_files(spark, joined, tmp_path):
    root, day = str(tmp_path / "results"), dt.date(2025, 1, 9)
    lines = report.report_lines(joined, day)
    for _ in range(2):  # a second run replaces the day's text
        files.write_reports(lines, root, day)
    stored = files.read_report_lines(spark, root, day)
    got = [r.value for r in stored.where("subreddit = 'openai'").orderBy("file_path", "line_no").collect()]
    want = [r.text for r in lines.where("subreddit = 'openai'").orderBy("section", "position", "line_no").collect()]
    assert got == want
    assert (tmp_path / "results/year=2025/month=01/day=09/subreddit=openai").is_dir()


def test_large_report_in_several_files(spark, tmp_path):
    root, day = str(tmp_path), dt.date(2025, 1, 9)
    n = F.col("id")
    lines = spark.range(5000).select(
        F.when(n % 3 == 0, "openai").otherwise("other").alias("subreddit"), (n % 2).alias("section"),
        n.alias("position"), F.lit(0).alias("line_no"), n.cast("string").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    files.write_reports(lines.repartition(5), root, day)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = files.read_report_lines(spark, root, day).where("subreddit = 'other'")
    assert stored.select("file_path").distinct().count() > 3
    got = [int(r.value) for r in stored.orderBy("file_path", "line_no").collect()]
    want = sorted((i for i in range(5000) if i % 3), key=lambda i: (i % 2, i))
    assert got == want


def test_clean_lines(spark, tmp_path):
    folder = tmp_path / "md"
    folder.mkdir()
    (folder / "llm_x.md").write_text("```\n# a  \n\nb```\n")
    (folder / "notes.md").write_text("skip")
    whole = files.read_markdown(spark, str(folder)).collect()
    assert [r.text for r in whole] == ["```\n# a  \n\nb```\n"]
    lines = files.clean_report_lines(spark.read.text(str(folder / "llm_x.md")))
    assert [r.value for r in lines.collect()] == ["# a", "", "b"]


def test_scan_reads_no_other_columns(joined):
    plan = report.rank_threads(joined)._jdf.queryExecution().optimizedPlan().toString()
    assert "comment_body" not in plan.split("LogicalRDD")[0]
    assert F is not None


def _report(n, community="openai", text="line"):
    return [(community, 2, i // 10, i % 10, f"{text} {i}") for i in range(n)]


LINES = "subreddit string, section int, position long, line_no int, text string"


def test_markdown_reports_are_read_back_as_written(spark, tmp_path):
    day, root = dt.date(2025, 1, 9), str(tmp_path)
    rows_ = _report(25) + _report(3, "datascience") + [("openai", 0, 0, 0, "---"), ("openai", 1, 0, 0, "")]
    files.write_markdown(spark.createDataFrame(rows_, LINES).repartition(7), root, day, lines_per_file=10)
    folder = tmp_path / "year=2025/month=01/day=09"
    names = sorted(str(p.relative_to(folder)) for p in folder.rglob("*.md"))
    assert names == ["subreddit=datascience/llm_datascience.md", "subreddit=openai/llm_openai.md",
                     "subreddit=openai/llm_openai_2.md", "subreddit=openai/llm_openai_3.md"]
    got = {(r.subreddit, r.file_no): r.text for r in files.read_markdown_reports(spark, root, day).collect()}
    whole = "".join(got["openai", i] for i in (1, 2, 3))
    assert whole == "---\n\n" + "".join(f"line {i}\n" for i in range(25))
    assert got["openai", 1].count("\n") == 10 and got["datascience", 1] == "line 0\nline 1\nline 2\n"


def test_a_second_run_replaces_its_reports_only(spark, tmp_path):
    day, root = dt.date(2025, 1, 9), str(tmp_path)
    first = _report(25) + _report(3, "datascience", "kept")
    files.write_markdown(spark.createDataFrame(first, LINES), root, day, lines_per_file=10)
    files.write_markdown(spark.createDataFrame(_report(4, text="new"), LINES), root, day, lines_per_file=10)
    got = {(r.subreddit, r.file_no): r.text for r in files.read_markdown_reports(spark, root, day).collect()}
    assert sorted(got) == [("datascience", 1), ("openai", 1)]
    assert got["openai", 1] == "new 0\nnew 1\nnew 2\nnew 3\n" and "kept 2" in got["datascience", 1]


def test_a_failed_write_leaves_the_old_reports(spark, tmp_path):
    from pyspark.errors import PySparkException

    day, root = dt.date(2025, 1, 9), str(tmp_path)
    files.write_markdown(spark.createDataFrame(_report(4), LINES), root, day)
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    broken = spark.createDataFrame(_report(40, text="new"), LINES).withColumn(
        "text", F.when(F.col("position") == 3, F.raise_error(F.lit("no text"))).otherwise(F.col("text")))
    with pytest.raises(PySparkException):
        files.write_markdown(broken, root, day)
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before
    (only,) = files.read_markdown_reports(spark, root, day).collect()
    assert only.text.startswith("line 0\n")


def test_many_short_files_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    """Files are numbered over the folders of several files; a re-run keeps other files."""
    from pyspark.sql.readwriter import DataFrameWriter

    tasks, write = [], DataFrameWriter.text

    def text(self, *args, **kwargs):
        tasks.append(self._df.rdd.getNumPartitions())
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "text", text)
    day, root = dt.date(2025, 1, 9), str(tmp_path)
    files.write_markdown(spark.createDataFrame(_report(2503, text="old"), LINES), root, day, lines_per_file=5)
    own = tmp_path / "year=2025/month=01/day=09/subreddit=openai"
    (own / "notes.txt").write_text("kept")
    files.write_markdown(spark.createDataFrame(_report(2503), LINES), root, day, lines_per_file=10)
    assert min(tasks) > 1
    got = {r.file_no: r.text for r in files.read_markdown_reports(spark, root, day).collect()}
    assert sorted(got) == list(range(1, 252)) and {got[i].count("\n") for i in range(1, 251)} == {10}
    assert "".join(got[i] for i in sorted(got)) == "".join(f"line {i}\n" for i in range(2503))
    assert (own / "notes.txt").read_text() == "kept"
    assert sorted(p.name for p in own.parent.iterdir()) == ["subreddit=openai"]
