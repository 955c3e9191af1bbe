"""Results of batches that add up to the results over all rows, and gates on batches."""

import datetime as dt
import random

import pytest

from threadglean.operators import increments, quality
from threadglean.operators.quality import Check
from threadglean.plans.daily import DailyRun
from threadglean.sources.tables import Tables
from tests.test_daily import DAY1, DAY2, entry, listing

CHECKS = [Check("k", "unique"), Check("k", "not_null"), Check("v", "unique"), Check("v", "is_int"),
          Check("v", "accepted_range", {"low": 0, "high": 5}, "warn")]


def table(report):
    return sorted(((r.column_name, r.test, r.severity, r.failed, r.sample) for r in report.collect()), key=repr)


def batches(spark, seed, n=3):
    rng = random.Random(seed)
    return [spark.createDataFrame(
        [(rng.choice([None, "a", "b", "c", "d", "e", f"x{rng.randrange(60)}"]), rng.choice([None, *range(-1, 8)]), g)
         for g in "uvw" for _ in range(rng.randrange(9))], "k string, v int, g string") for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_batches_add_up_to_the_whole(spark, seed):
    parts = batches(spark, seed)
    results, stored = [], None
    for part in parts:
        results.append(increments.batch_results(part, "t", CHECKS, stored, key="k"))
        stored = part if stored is None else stored.unionByName(part)
    assert table(increments.merge_results(results)) == table(quality.run_checks(stored, "t", CHECKS, "k"))


def test_groups_add_up_too(spark):
    first, second, _ = batches(spark, 9)
    results = [increments.batch_results(first, "t", CHECKS, None, by="g"),
               increments.batch_results(second, "t", CHECKS, first, by="g")]
    got = {(r.g, r.column_name, r.test): r.failed for r in increments.merge_results(results, by="g").collect()}
    want = {(r.g, r.column_name, r.test): r.failed
            for r in quality.run_checks(first.unionByName(second), "t", CHECKS, by="g").collect()}
    assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n}


def test_empty_batch_and_empty_store(spark):
    part = batches(spark, 3)[0]
    none = part.limit(0)
    assert {r.failed for r in increments.batch_results(none, "t", CHECKS, none).collect()} == {0}
    assert table(increments.batch_results(part, "t", CHECKS, none, "k")) == table(
        quality.run_checks(part, "t", CHECKS, "k"))


def test_gates_read_batches_only(spark, tmp_path):
    """Faults of an earlier run do not stop a later one; the results of all runs keep them."""
    run = DailyRun(Tables(spark, str(tmp_path)), DAY1)
    run.ingest(listing(spark, entry("p1", 1, "x", score=-4), entry("p2", 2, "y")))
    with pytest.raises(quality.QualityError, match=r"raw_posts.score expression_is_true: 1 \(e.g. p1\)"):
        run.gate("raw", ["raw_posts"])
    later = DailyRun(run.tables, DAY2)
    later.ingest(listing(spark, entry("p3", 30, "z")))
    assert later.gate("raw", ["raw_posts"]) == []
    total = {(r.column_name, r.test): r.failed for r in later.results(all_runs=True).collect()}
    whole = {(r.column_name, r.test): r.failed for r in quality.run_suites(
        {"raw_posts": run.tables.read("raw_posts")}, {"raw_posts": [Check("score", "expression_is_true"),
                                                                    Check("post_id", "unique")]}).collect()}
    assert whole.items() <= total.items() and total["score", "expression_is_true"] == 1
    read = later.results().inputFiles()
    assert read and all("/test_results/" in f for f in read)


def test_results_of_a_run_are_those_of_its_time(spark, tmp_path):
    run = DailyRun(Tables(spark, str(tmp_path)), DAY1)
    assert run.results().count() == 0
    run.ingest(listing(spark, entry("p1", 1, "x")))
    assert run.results().count() > 5
    assert DailyRun(run.tables, DAY1 + dt.timedelta(seconds=1)).results().count() == 0
