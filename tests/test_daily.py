"""The whole run: two days, re-runs, gates."""

import datetime as dt

import pytest

from threadglean.operators import analysis
from threadglean.operators.quality import QualityError
from threadglean.plans.daily import DailyRun, run_day
from threadglean.schemas import LANDING
from threadglean.sources.tables import Tables
from tests.helpers import rows

DAY1, DAY2 = dt.datetime(2025, 1, 9, 22), dt.datetime(2025, 1, 10, 22)


def epoch(hours):
    return (dt.datetime(2025, 1, 9, tzinfo=dt.timezone.utc) + dt.timedelta(hours=hours)).timestamp()


def entry(post, hours, *bodies, community="openai", title="A title", score=5):
    comments = [(body, "someone", f"{post}c{i}", epoch(hours) + i + 1) for i, body in enumerate(bodies)]
    return (post, community, title, "someone", f"http://x/{post}", score, epoch(hours), 1, comments)


def listing(spark, *entries):
    return spark.createDataFrame(list(entries), LANDING)


def state(run):
    t = run.tables
    return {name: rows(t.read(name)) for name in (
        "raw_posts", "posts", "comments", "daily_summary_data", "text_summary_results",
        "sentiment_analysis_results", "processing_metadata", "update_processing_status")}


def test_two_days(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    long = "Happy words. " * 40
    first = listing(
        spark, entry("p1", 1, "wtf is this", long, "fine text"), entry("p2", 2, "other", title="[deleted]"),
        entry("p3", 3, community="datascience"), entry("p4", 4, "x", community="elsewhere"))
    run = run_day(spark, root, first, DAY1, out)
    t = run.tables
    assert run.counts["raw_posts"] == 3 and run.counts["posts"] == 2 and run.counts["comments"] == 4
    assert run.counts["failed"] == {"summarize": 0, "classify": 0}
    summary = t.read("daily_summary_data").collect()
    assert sorted(r.id for r in summary) == [1, 2, 3]  # the comment of the invalid post is out
    assert {r.comment_body for r in summary} == {"*** is this", long, "fine text"}
    assert not any(r.needs_processing for r in summary)
    assert analysis.staging(t.read("daily_summary_data")).count() == 0
    assert t.read("joined_summary_analysis").count() == 3
    marks = {r.subreddit: r.last_processed_utc for r in t.read("processing_metadata").collect()}
    assert marks == {"openai": int(epoch(2)), "datascience": int(epoch(3))}
    assert (tmp_path / "out/year=2025/month=01/day=09/subreddit=openai").is_dir()

    before = state(run)
    again = run_day(spark, root, first, DAY1 + dt.timedelta(hours=1), out)
    assert state(again) == before
    assert again.counts["daily_summary_data"] == 0

    second = listing(
        spark, entry("p1", 1, "late comment on an old post"),
        entry("p5", 30, "new one"), entry("p6", 0, "posted before the mark"))
    run2 = run_day(spark, root, second, DAY2, out)
    added = [r for r in run2.tables.read("daily_summary_data").collect() if r.id > 3]
    assert [(r.post_id, r.id) for r in added] == [("p5", 4)]
    assert run2.tables.read("joined_summary_analysis").count() == 1  # holds the current batch only
    assert run2.tables.read("text_summary_results").count() == 4


def test_failed_models_are_kept_out(spark, tmp_path):
    def load():
        def model(texts):
            raise ValueError("no model")
        return model

    long = "Happy words. " * 40
    run = DailyRun(Tables(spark, str(tmp_path)), DAY1, summarizer=load, classifier=load)
    run.ingest(listing(spark, entry("p1", 1, long, "short")))
    run.preprocess()
    run.summarise_day()
    assert run.enrich() == {"summarize": 1, "classify": 2}
    run.analyse()
    joined = run.tables.read("joined_summary_analysis").collect()
    assert [(r.comment_body, r.sentiment_label, r.sentiment_score) for r in joined] == [("short", "Neutral", 0.0)]
    assert run.tables.read("update_processing_status").count() == 2  # failed rows are not tried again


def test_event_time_window_takes_late_posts(spark, tmp_path):
    for mode, want in (("faithful", 1), ("event_time", 2)):
        run = DailyRun(Tables(spark, str(tmp_path / mode)), DAY2, window_mode=mode)
        run.ingest(listing(spark, entry("p1", 1, "one")))
        run.preprocess()
        run.summarise_day()
        run.ingest(listing(spark, entry("p2", 5, "two")))
        run.preprocess()
        run.summarise_day()
        assert run.tables.read("daily_summary_data").count() == want


def test_gate_stops_the_run(spark, tmp_path):
    bad = listing(spark, entry("p1", 1, "x", score=-4))
    with pytest.raises(QualityError, match="raw_posts.score expression_is_true"):
        run_day(spark, str(tmp_path / "s"), bad, DAY1, str(tmp_path / "o"))
    assert Tables(spark, str(tmp_path / "s")).read("daily_summary_data").count() == 0
    with pytest.raises(QualityError, match="raw_posts.score expression_is_true: 1 .* in openai"):
        run_day(spark, str(tmp_path / "t"), bad, DAY1, str(tmp_path / "o"), gate_by="subreddit")


def test_landing_stream(spark, tmp_path):
    from threadglean.streaming.landing import ingest_available

    land, progress = str(tmp_path / "land"), str(tmp_path / "progress")
    run = DailyRun(Tables(spark, str(tmp_path / "store")), DAY1)
    listing(spark, entry("p1", 1, "one")).coalesce(1).write.json(land + "/first")
    ingest_available(run, land, progress)
    assert [r.post_id for r in run.tables.read("posts").collect()] == ["p1"]
    listing(spark, entry("p1", 1, "one"), entry("p2", 5, "two")).coalesce(1).write.json(land + "/second")
    ingest_available(run, land, progress)
    assert sorted(r.post_id for r in run.tables.read("raw_posts").collect()) == ["p1", "p2"]
    assert run.tables.read("comments").count() == 2
    before = state(run)
    ingest_available(run, land, progress)  # nothing new
    assert state(run) == before


def test_a_listing_in_several_files_loses_nothing(spark, tmp_path):
    """Older posts in a later file of the listing, and two listings waiting at once."""
    from threadglean.streaming.landing import ingest_available

    posts = [entry(f"p{i}", 20 - i, f"text {i}") for i in range(6)]
    land = str(tmp_path / "land")
    for i in range(0, 6, 3):
        listing(spark, *posts[i:i + 3]).coalesce(1).write.mode("append").json(land + "/monday")
    listing(spark, posts[0], entry("q1", 30, "later")).coalesce(1).write.json(land + "/tuesday")
    streamed = DailyRun(Tables(spark, str(tmp_path / "a")), DAY1)
    ingest_available(streamed, land, str(tmp_path / "progress"))
    batch = DailyRun(Tables(spark, str(tmp_path / "b")), DAY1)
    batch.ingest(listing(spark, *posts))
    batch.preprocess()
    batch.ingest(listing(spark, posts[0], entry("q1", 30, "later")))
    batch.preprocess()
    assert state(streamed) == state(batch)
    assert streamed.tables.read("posts").count() == 7


@pytest.mark.parametrize("failing", [1, 2, 3, 4, 5, 6, 7])
def test_a_failure_between_two_writes_loses_nothing(spark, tmp_path, monkeypatch, failing):
    entries = [entry(f"p{i}", i + 1, f"text {i}") for i in range(4)]
    clean = DailyRun(Tables(spark, str(tmp_path / "clean")), DAY1)
    clean.ingest(listing(spark, *entries))
    clean.preprocess()

    run = DailyRun(Tables(spark, str(tmp_path / "broken")), DAY1)
    write, writes = Tables._write, []

    def broken(self, df, name, path, mode, **options):
        writes.append(name)
        if len(writes) == failing:
            raise OSError("the disk went away")
        return write(self, df, name, path, mode, **options)

    monkeypatch.setattr(Tables, "_write", broken)
    with pytest.raises(OSError):
        run.ingest(listing(spark, *entries))
        run.preprocess()
    monkeypatch.setattr(Tables, "_write", write)
    run.ingest(listing(spark, *entries))
    run.preprocess()
    assert state(run) == state(clean)


def test_caps_are_settings(spark, tmp_path):
    entries = [entry(f"p{i}", i + 1, *[f"text {j}" for j in range(13)]) for i in range(23)]
    for caps, want in (({}, (20, 200)), ({"posts_per_community": None, "comments_per_post": None}, (23, 299)),
                       ({"posts_per_community": 2, "comments_per_post": 3}, (2, 6))):
        run = DailyRun(Tables(spark, str(tmp_path / str(want[0]))), DAY1, **caps)
        run.ingest(listing(spark, *entries))
        run.preprocess()
        assert (run.tables.read("posts").count(), run.tables.read("comments").count()) == want


def test_report_skips_harmful_items_and_is_cleaned(spark, tmp_path):
    from threadglean import constants as K

    first = listing(spark, entry("p1", 1, "```", "a ```code``` word", "bad stuff here"), entry("p2", 2, "fine"))
    out = str(tmp_path / "out")
    run = run_day(spark, str(tmp_path / "store"), first, DAY1, out, harmful=r"\bbad\b")
    text = "\n".join(r.value for r in spark.read.text(out, recursiveFileLookup=True).collect())
    assert K.HARMFUL_MESSAGE in text and "bad stuff" not in text and "```" not in text and "fine" in text
    assert run.counts["new_by_community"] == {"openai": 4, None: 4}
    ids = spark.createDataFrame([("p2c0",)], "comment_id string")
    run.harmful = ids
    run.report(out)
    text = "\n".join(r.value for r in spark.read.text(out, recursiveFileLookup=True).collect())
    assert "bad stuff" in text and text.count(K.HARMFUL_MESSAGE) >= 1


def test_prompts_with_header_and_model(spark, tmp_path):
    from pyspark.sql import functions as F, types as T

    first = listing(spark, entry("p1", 1, "one", "two"), entry("p3", 3, "x y", community="datascience"))
    run = run_day(spark, str(tmp_path / "store"), first, DAY1, str(tmp_path / "out"))

    def load():
        import pandas as pd

        return lambda texts: pd.DataFrame({"answer": "seen " + texts.str.slice(0, 12)})

    header = F.concat(F.lit("About "), "subreddit", F.lit(":\n"))
    got = run.prompts(header, load, {"answer": T.StringType()}, blocks_per_part=1).collect()
    assert sorted((r.subreddit, r.part_no, r.n_blocks) for r in got) == [
        ("datascience", 0, 1), ("openai", 0, 1), ("openai", 1, 1)]
    assert all(r.text.startswith(f"About {r.subreddit}:\n~~~") for r in got)
    assert all(r.error is None and r.answer == "seen " + r.text[:12] for r in got)


def test_a_repeated_key_is_refused(spark, tmp_path):
    from threadglean.sources.tables import DuplicateKey

    run = DailyRun(Tables(spark, str(tmp_path)), DAY1)
    run.ingest(listing(spark, entry("p1", 1, "one")))
    run.preprocess()
    stored = run.tables.read("posts")
    with pytest.raises(DuplicateKey):
        run._append("posts", stored)
