"""Data-quality tests: many checks in one pass over a table.

A check is data. All row-wise checks of a table become one aggregate; all
uniqueness checks become one grouped count.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import functions as F, types as T

from threadglean import constants as K

INT_MIN, INT_MAX = -2147483648, 2147483647


@dataclass(frozen=True)
class Check:
    column: str
    test: str
    args: dict = field(default_factory=dict)
    severity: str = "error"


class QualityError(AssertionError):
    """A gate found failed checks."""


# --- row-wise tests: true where the row fails -----------------------------------------

def not_null(c, dtype):
    return c.isNull()


def accepted_values(c, dtype, values):
    """A null passes."""
    return ~c.isin(list(values))


def text_failure(c, dtype, min_length=1, max_length=65535, allow_null=False, regex=None):
    """Reason a text fails, null if it passes. Nulls fail whatever `allow_null` says."""
    reason = F.when(c.isNull(), "NULL value")
    if not isinstance(dtype, (T.StringType, T.VarcharType)):
        return reason.otherwise("Invalid type")
    reason = reason.when(F.length(c) < min_length, "Too short").when(F.length(c) > max_length, "Too long")
    if regex is not None:
        reason = reason.when(~c.rlike(regex), "Failed pattern match")
    return reason


def is_text(c, dtype, **args):
    return text_failure(c, dtype, **args).isNotNull()


def is_int(c, dtype, min_value=INT_MIN, max_value=INT_MAX):
    """Not digits and minus signs, not an int, out of range or not whole; a null passes.

    A value that cannot be cast is a failing row, not an error.
    """
    text = c.cast("string")
    number = text.try_cast("double")
    return c.isNotNull() & (
        ~text.rlike(r"\A[0-9-]+\z") | text.try_cast("int").isNull()
        | F.coalesce((number < min_value) | (number > max_value) | (number != F.floor(number)), F.lit(True))
    )


def is_json(c, dtype):
    return c.isNotNull() & F.try_parse_json(c).isNull()


def is_timestamp(c, dtype):
    return c.isNotNull() & c.try_cast("timestamp").isNull()


def is_bigint(c, dtype):
    return c.isNotNull() & c.cast("string").try_cast("bigint").isNull()


def is_string(c, dtype):
    """Blank, or with a character outside printable ASCII and white space; a null passes."""
    text = c.cast("string")
    return c.isNotNull() & ((F.length(F.trim(text)) == 0) | text.rlike(r"[^\x20-\x7E\s]"))


def at_least(c, dtype, low=0):
    """`expression_is_true: column >= low`; a null passes."""
    return ~(c >= low)


def accepted_range(c, dtype, low=0, high=1):
    """Inclusive; a null passes."""
    return ~c.between(low, high)


def valid_comment_length(c, dtype):
    return (F.length(F.trim(c)) < K.MIN_BODY_CHARS) | (F.length(c) > K.MAX_BODY_CHARS)


def summary_not_longer(c, dtype, body="comment_body"):
    return c.isNotNull() & (F.length(c) > F.length(F.col(body)))


def sentiment_consistency(c, dtype, label="sentiment_label"):
    return c.isNotNull() & F.col(label).isNotNull() & ((c < 0) | (c > 1))


ROW_TESTS = {
    "not_null": not_null,
    "accepted_values": accepted_values,
    "is_text": is_text,
    "is_int": is_int,
    "is_json": is_json,
    "is_timestamp": is_timestamp,
    "is_bigint": is_bigint,
    "is_string": is_string,
    "expression_is_true": at_least,
    "accepted_range": accepted_range,
    "valid_comment_length": valid_comment_length,
    "summary_quality": summary_not_longer,
    "sentiment_consistency": sentiment_consistency,
    "warn_if_null": not_null,
}


def failing(df, check):
    """Column: true where a row fails `check`, never null."""
    dtype = df.schema[check.column].dataType
    failed = ROW_TESTS[check.test](F.col(check.column), dtype, **check.args)
    return F.coalesce(failed, F.lit(False))


def failing_rows(df, check):
    """The rows that fail a check; for a text check with its reason and length,
    for uniqueness the values that occur more than once and how often."""
    if check.test == "unique":
        c = check.column
        return (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n_records"))
                .where(F.col("n_records") > 1))
    rows = df.where(failing(df, check))
    if check.test == "is_text":
        c = F.col(check.column)
        rows = rows.withColumn(
            "failure_reason", text_failure(c, df.schema[check.column].dataType, **check.args)
        ).withColumn("text_length", F.length(c.cast("string")))
    elif check.test == "is_int":
        rows = rows.withColumn("failure_reason", F.lit("Failed integer validation"))
    return rows


def run_checks(df, table, checks, key=None, by=None):
    """One row per check: table_name, column_name, test, severity, failed, sample.

    `failed` is the number of failing rows (for unique: of repeated values);
    `sample` the smallest `key` among them (for unique: the smallest value).
    With `by`, one row per check and group: the same test over each member of a
    family of tables. Its row-wise checks come without a sample, so that only
    counters are kept per group and no rows are sorted.
    """
    groups = [by] if by else []
    key = None if by else key
    row_checks = [c for c in checks if c.test != "unique"]
    unique = [c for c in checks if c.test == "unique"]
    shape = [*groups, "table_name", "column_name", "test", "severity", "failed", "sample"]
    parts = []
    if row_checks:
        aggregates = []
        for i, check in enumerate(row_checks):
            failed = failing(df, check)
            aggregates.append(F.count_if(failed).alias(f"__n{i}"))
            if key:
                aggregates.append(F.min(F.when(failed, F.col(key).cast("string"))).alias(f"__s{i}"))
        counted = df.groupBy(*groups).agg(*aggregates)
        entries = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(c.column).alias("column_name"),
                F.lit(c.test).alias("test"), F.lit(c.severity).alias("severity"),
                F.col(f"__n{i}").alias("failed"),
                (F.col(f"__s{i}") if key else F.lit(None).cast("string")).alias("sample"))
            for i, c in enumerate(row_checks)]
        parts.append(counted.select(*groups, F.inline(F.array(*entries))))
    if unique:
        values = F.array(*[
            F.struct(F.lit(c.column).alias("column_name"), F.col(c.column).cast("string").alias("value"))
            for c in unique])
        # Only values that occur more than once go on; the columns give the zeros.
        repeated = (
            df.select(*groups, F.inline(values)).where(F.col("value").isNotNull())
            .groupBy(*groups, "column_name", "value").agg(F.count("*").alias("__n")).where(F.col("__n") > 1)
            .groupBy(*[F.col(g).alias("__g_" + g) for g in groups], F.col("column_name").alias("__column"))
            .agg(F.count("*").alias("failed"), F.min("value").alias("sample"))
        )
        names = F.explode(F.array(*[F.lit(c.column) for c in unique])).alias("column_name")
        listed = (df.select(*groups).distinct() if groups else df.sparkSession.range(1)).select(*groups, names)
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col("__g_" + g)) for g in groups],
                      F.col("column_name") == F.col("__column"))
        parts.append(listed.join(repeated, same, "left").select(
            *groups, F.lit(table).alias("table_name"), "column_name", F.lit("unique").alias("test"),
            F.lit(unique[0].severity).alias("severity"), F.coalesce("failed", F.lit(0)).alias("failed"), "sample"))
    return reduce(lambda a, b: a.unionByName(b), [p.select(*shape) for p in parts])


def run_suites(frames, suites, keys=None, by=None):
    """Report of all suites over a name -> frame mapping. `by` is used for the
    tables that have that column."""
    keys = keys or {}
    reports = []
    for table, df in frames.items():
        group = by if by in df.columns else None
        report = run_checks(df, table, suites[table], keys.get(table), group)
        if by and not group:
            report = report.withColumn(by, F.lit(None).cast("string"))
        reports.append(report)
    return reduce(lambda a, b: a.unionByName(b), reports)


def assert_quality(report, stage):
    """Gate: raises if a check of severity error failed; warnings pass. Returns
    the failed rows (one per failed check of the declared suites, so few)."""
    failed = report.where(F.col("failed") > 0).collect()
    errors = [r for r in failed if r["severity"] == "error"]
    if errors:
        groups = [c for c in report.columns
                  if c not in ("table_name", "column_name", "test", "severity", "failed", "sample")]
        lines = [f"{r['table_name']}.{r['column_name']} {r['test']}: {r['failed']} (e.g. {r['sample']})"
                 + "".join(f" in {r[c]}" for c in groups if r[c] is not None) for r in errors]
        raise QualityError(f"{stage}: " + "; ".join(lines))
    return failed
