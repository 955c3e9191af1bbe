"""Test results that add up (Q2, Q17, Q18): each batch is tested once, when it comes.

A result has the columns of `quality.run_checks`. Row tests add up by themselves. A
value that a batch repeats, or has in common with the rows stored before, counts in the
batch with which it became repeated, so uniqueness adds up too: the merged results of all
batches equal those of the suite over all rows.
"""

from functools import reduce

from pyspark.sql import functions as F

from threadglean.operators import quality, scale

RESULT = ["table_name", "column_name", "test", "severity"]


def _values(df, columns, groups=()):
    """column_name and value of each non-null entry of the columns to be unique."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(*groups, F.inline(pairs)).where(F.col("value").isNotNull())


def _newly_repeated(batch, stored, columns, groups):
    """column_name, value: values that are repeated since this batch."""
    keys = [*groups, "column_name", "value"]
    own = _values(batch, columns, groups).groupBy(*keys).agg(F.count("*").alias("n"))
    if stored is None:
        return own.where("n > 1")
    # Of the stored rows only the columns to be unique are read, and while the batch has few
    # values the others are filtered out as they are scanned. Null groups are given a name.
    named = [F.coalesce(F.col(g).cast("string"), F.lit("")).alias(g) for g in groups]
    known = _values(stored, columns, groups).select(*named, "column_name", "value")
    own = own.select(*named, "column_name", "value", "n")
    before = scale.narrow_to(known, own, keys).groupBy(*keys).agg(F.count("*").alias("m"))
    m = F.coalesce("m", F.lit(0))
    return own.join(before, keys, "left").where((F.col("n") + m > 1) & (m <= 1))


def batch_results(batch, table, checks, stored=None, key=None, by=None):
    """Results of one batch, in the shape of `quality.run_checks`.

    `stored` holds the rows before the batch; without it the batch is the first (or its
    rows replace stored ones). For uniqueness `failed` counts the values that became
    repeated with this batch. An empty batch has results of 0 failures (with `by`: none).
    """
    rows = [c for c in checks if c.test != "unique"]
    unique = [c for c in checks if c.test == "unique"]
    groups = [by] if by else []
    parts = [quality.run_checks(batch, table, rows, key, by)] if rows else []
    if unique:
        columns = [c.column for c in unique]
        repeated = _newly_repeated(batch, stored, columns, groups).groupBy(*groups, "column_name").agg(
            F.count("*").alias("failed"), F.min("value").alias("sample"))
        found = repeated.select(
            *groups, F.lit(table).alias("table_name"), "column_name", F.lit("unique").alias("test"),
            F.lit(unique[0].severity).alias("severity"), "failed", "sample")
        zeros = batch.sparkSession.createDataFrame(
            [(table, c.column, "unique", c.severity, 0, None) for c in unique],
            "table_name string, column_name string, test string, severity string, failed long, sample string")
        parts.append(found if by else merge_results([found, zeros]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_results(results, by=None):
    """One row per test (and group) over the results of several batches."""
    every = reduce(lambda a, b: a.unionByName(b), results)
    return every.groupBy(*([by] if by else []), *RESULT).agg(
        F.sum("failed").alias("failed"), F.min("sample").alias("sample"))
