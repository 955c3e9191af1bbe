"""High-water marks and incremental reads.

Three marks exist and differ: the source mark per community (event time of
accepted posts), the processed mark per community (largest stored event time),
and one summary mark over all communities (largest processing time).
"""

from functools import reduce

from pyspark.sql import functions as F

from threadglean.operators import scale
from threadglean.operators.merge import merge_keyed


def epoch(ts):
    """Timestamp as epoch seconds with fraction."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("double")


def high_water_mark(df, ts="created_utc"):
    """One row, `mark`: largest epoch of `ts`, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(epoch(ts)), F.lit(0.0)).alias("mark"))


def high_water_marks(df, ts="created_utc", by="subreddit"):
    """Largest epoch of `ts` per community."""
    return df.groupBy(by).agg(F.max(epoch(ts)).alias("mark"))


def last_run_mark(summary_table, ts="processed_date"):
    """One row, `mark`: largest processing time, null on the first run."""
    return summary_table.agg(F.max(ts).alias("mark"))


def rows_after(df, mark, ts="created_utc"):
    """Rows with a time strictly after `mark` (epoch seconds)."""
    limit = F.timestamp_micros(F.lit(round(mark * 1_000_000)).cast("long"))
    return df.where(F.col(ts) > limit)


def new_rows_by_mark(df, marks, ts="created_utc", by="subreddit"):
    """Rows strictly after the mark of their community; without a mark, after 0.

    `marks` has `by` and `mark` (epoch seconds, double). Marks of a bounded
    number of communities become literal predicates that reach the Parquet scan
    and its partition filter; more of them are joined.
    """
    pinned, ok = scale.pin_small(marks.where(F.col(by).isNotNull()), 1000)
    if not ok:
        joined = scale.skew_join(df, marks, by, "left", [ts, by])
        return joined.where(epoch(ts) > F.coalesce("mark", F.lit(0.0))).drop("mark")

    def after(mark):
        return F.col(ts) > F.timestamp_micros(F.lit(round((mark or 0) * 1_000_000)).cast("long"))

    known = {row[by]: row["mark"] for row in pinned.collect()}
    unknown = F.col(by).isNull() | ~F.col(by).isin(list(known)) if known else F.lit(True)
    tests = [unknown & after(0)]
    tests += [(F.col(by) == name) & after(mark) for name, mark in known.items()]
    return df.where(reduce(lambda a, b: a | b, tests))


def time_range(df, low, high, ts="created_utc"):
    """Rows in (low, high]; `low` None means no lower bound. `low` and `high` are
    datetimes or columns."""
    kept = F.col(ts) <= F.lit(high)
    if low is not None:
        kept = kept & (F.col(ts) > F.lit(low))
    return df.where(kept)


def advance_marks(marks, accepted, run_ts, ts="created_utc"):
    """Marks table after a run: a community's mark moves to the largest epoch of
    its accepted rows if that is larger; an update stamps the run time.

    `marks` has subreddit, last_processed_utc, last_run_timestamp; `accepted`
    has subreddit and `ts` as a timestamp.
    """
    reached = (
        accepted.groupBy("subreddit")
        .agg(F.round(F.max(epoch(ts))).cast("long").alias("last_processed_utc"),
             F.max(epoch(ts)).alias("__exact"))
    )
    old = marks.select("subreddit", F.col("last_processed_utc").alias("__old"))
    moved = (
        scale.lookup_join(reached, old, "subreddit")
        .where(F.col("__exact") > F.coalesce("__old", F.lit(0)))
        .select("subreddit", "last_processed_utc",
                F.lit(run_ts).cast("timestamp").alias("last_run_timestamp"))
    )
    return merge_keyed(marks, moved, ["subreddit"], "take_new", unique=True)
