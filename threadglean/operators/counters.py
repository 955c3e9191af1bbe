"""Row counters taken while a write runs, and counts of stored tables."""

from functools import reduce

from pyspark.sql import Observation, functions as F


def observed(df, name):
    """(df, observation): `observation.get["rows"]` is known once `df` is written."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def row_counts(tables):
    """Rows per table of a name -> frame mapping."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
               for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), counted)


def null_counts(df, columns):
    """Nulls per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
    return counted.select(F.inline(F.array(*pairs)))


def funnel(stages):
    """Rows per stage in order, and their share of the first stage."""
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(i).alias("stage_no"),
                                                           F.lit(name).alias("stage"), "n_rows")
               for i, (name, df) in enumerate(stages.items(), 1)]
    return reduce(lambda a, b: a.unionByName(b), counted)
