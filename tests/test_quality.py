import pytest

from threadglean.operators import counters, quality
from threadglean.operators.quality import Check
from threadglean.operators.suites import SUITES, declared_tests
from tests.helpers import rows


def fails(spark, test, cells, dtype, args):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(cells)], f"i int, c {dtype}")
    bad = df.where(quality.failing(df, Check("c", test, args)))
    return sorted(r.i for r in bad.collect())


def test_declared_tests():
    assert declared_tests() == 390
    assert {len(SUITES[t]) for t in ("raw_posts",)} == {13}


@pytest.mark.parametrize("test, values, dtype, args, want", [
    ("not_null", [None, "", "x"], "string", {}, [0]),
    ("accepted_values", [None, "a", "z"], "string", {"values": ["a"]}, [2]),
    ("is_text", [None, "", "x", "x" * 65535, "x" * 65536], "string", {}, [0, 1, 4]),
    ("is_text", [None, "x"], "string", {"allow_null": True}, [0]),
    ("is_text", ["ab", "12"], "string", {"regex": "[a-z]"}, [1]),
    ("is_text", [1, None], "int", {}, [0, 1]),
    ("is_int", [None, "12", "-5", "12a", "1.5", "2147483648", "1-2", ""], "string", {}, [3, 4, 5, 6, 7]),
    ("is_int", [5, 50], "int", {"max_value": 10}, [1]),
    ("is_int", [2**31, 1], "bigint", {}, [0]),
    ("is_json", [None, "{}", "[1]", "{bad", "5", ""], "string", {}, [3, 5]),
    ("is_timestamp", [None, "2025-01-09", "2025-01-09 22:00:01", "bad", "2025-13-01"], "string", {}, [3, 4]),
    ("is_bigint", [None, "9223372036854775807", "9223372036854775808", "x"], "string", {}, [2, 3]),
    ("is_string", [None, "ok\n", " ", "", "é", "\x01"], "string", {}, [2, 3, 4, 5]),
    ("expression_is_true", [None, 0, -1], "int", {}, [2]),
    ("accepted_range", [None, 0.0, 1.0, 1.0000001, -0.1], "double", {}, [3, 4]),
    ("valid_comment_length", [None, " a", "ab", "x" * 10000, "x" * 10001], "string", {}, [1, 4]),
])
def test_row_tests(spark, test, values, dtype, args, want):
    assert fails(spark, test, values, dtype, args) == want


def test_two_column_tests(spark):
    df = spark.createDataFrame(
        [("s1", "s1", 0.5, "x"), ("s12", "s1", 2.0, None), (None, "b", -1.0, "x"), ("x", None, None, "x")],
        "comment_summary string, comment_body string, sentiment_score double, sentiment_label string")
    report = quality.run_checks(df, "t", [
        Check("comment_summary", "summary_quality"), Check("sentiment_score", "sentiment_consistency")])
    assert [r.failed for r in report.collect()] == [1, 1]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame(
        [("a", "k1", 1), ("a", "k1", -1), ("b", "k2", None), ("b", None, -5), ("b", None, 3)],
        "subreddit string, k string, v int")


CHECKS = [Check("k", "unique"), Check("k", "not_null"), Check("v", "expression_is_true"),
          Check("v", "warn_if_null", severity="warn")]


def test_run_checks(table):
    got = {(r.column_name, r.test): (r.failed, r.sample, r.severity)
           for r in quality.run_checks(table, "t", CHECKS, "k").collect()}
    assert got == {("k", "unique"): (1, "k1", "error"), ("k", "not_null"): (2, None, "error"),
                   ("v", "expression_is_true"): (2, "k1", "error"), ("v", "warn_if_null"): (1, "k2", "warn")}
    by = quality.run_checks(table, "t", CHECKS, "k", by="subreddit")
    got = {(r.subreddit, r.test): r.failed for r in by.collect()}
    assert got[("a", "unique")] == 1 and got[("b", "not_null")] == 2 and got[("a", "not_null")] == 0
    assert len(got) == 8


def test_gate(table):
    good = quality.run_checks(table, "t", [Check("v", "warn_if_null", severity="warn")], "k")
    assert len(quality.assert_quality(good, "s")) == 1
    with pytest.raises(quality.QualityError, match="t.k unique: 1"):
        quality.assert_quality(quality.run_checks(table, "t", CHECKS, "k"), "s")


def test_failing_rows(table):
    assert rows(quality.failing_rows(table, Check("k", "unique"))) == [("k1", 2)]
    reasons = quality.failing_rows(table, Check("k", "is_text", {"min_length": 3}))
    assert sorted(r.failure_reason for r in reasons.collect()) == ["NULL value"] * 2 + ["Too short"] * 3


def test_all_suites_compile(spark):
    from threadglean.schemas import TABLES
    frames = {t: spark.createDataFrame([], TABLES[t]) for t in SUITES if t in TABLES}
    report = quality.run_suites(frames, SUITES)
    assert quality.assert_quality(report, "empty") == []
    assert rows(counters.null_counts(frames["posts"], ["title", "url"])) == [("title", 0), ("url", 0)]
    assert rows(counters.row_counts({"x": frames["posts"]})) == [("x", 0)]
