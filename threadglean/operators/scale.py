"""Helpers that keep joins, broadcasts and rankings safe on skewed large data.

The size checks below only choose between two ways to the same rows.
"""

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Window, functions as F

from threadglean.session import checkpoint_folder

# A plan whose inputs are together below this size is run the plain way
# (session setting threadglean.smallInputBytes).
SMALL_INPUT_BYTES = 128 * 1024 * 1024
# Most rows that are ever pulled to the driver and sent to all executors.
PIN_MAX_ROWS = 10_000
# Rows of one hot key that one task should get
# (session setting threadglean.hotRowsPerTask).
HOT_ROWS_PER_TASK = 1_000_000
# Input that one task of a range-partitioned ranking should get, and the most
# (group, range) counts that are sent to all executors.
RANK_BYTES_PER_TASK = 256 * 1024 * 1024
RANK_PIN_ROWS = 200_000
# Keys of a batch that are sent to all executors to narrow a stored table.
NARROW_PIN_ROWS = 200_000
# monotonically_increasing_id keeps the partition above this bit, the row below.
_ROW_BITS = 33


def input_bytes(df):
    """Size of all inputs of a plan, as Catalyst knows it after pruning.

    Every join of this library gives a left row at most one partner, so the
    inputs bound the result, where the planner's own join estimate is a product.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _setting(df, name, default):
    return int(df.sparkSession.conf.get(f"threadglean.{name}", str(default)))


def is_small(df, limit=None):
    if limit is None:
        limit = _setting(df, "smallInputBytes", SMALL_INPUT_BYTES)
    return input_bytes(df) <= limit


def spread_small(df):
    """Deal the rows of a small input over all cores before costly row work; a
    large input already comes in many splits and stays as it is."""
    if not is_small(df):
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# Copies of the innermost `stored_copies` block.
_copies = []


@contextmanager
def stored_copies():
    """Delete the copies that `cut_lineage` stores in this block when it ends. Frames built on
    them must be written or collected by then."""
    _copies.append([])
    try:
        yield
    finally:
        for fs, path in _copies.pop():
            fs.delete(path, True)


def scratch_folder(spark, name):
    """A new path in the shared checkpoint folder. It goes with its `stored_copies` block, else
    when the session ends."""
    path = f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.deleteOnExit(hadoop_path)
    if _copies:
        _copies[-1].append((fs, hadoop_path))
    return path


def cut_lineage(df):
    """The rows stored as Parquet in the shared checkpoint folder and read back.

    Later stages restart from stored rows, read only the columns they need and
    know their size.
    """
    path = scratch_folder(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_small(df, max_rows=PIN_MAX_ROWS):
    """(frame, True) with the rows held locally if there are at most `max_rows`,
    else (df, False)."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df, False
    return df.sparkSession.createDataFrame(rows, df.schema), True


def lookup_join(big, small, on, how="left", spread=None, max_rows=PIN_MAX_ROWS):
    """Join with a lookup side: broadcast while it is proven small, else a
    skew-safe shuffle join."""
    pinned, ok = pin_small(small, max_rows)
    if ok:
        return big.join(F.broadcast(pinned), on, how)
    return skew_join(big, small, on, how, spread, small_limit=0)


def narrow_to(stored, batch, keys, max_rows=NARROW_PIN_ROWS):
    """A stored table without most rows that no key of the batch can meet.

    While the batch has few keys the table is filtered as it is scanned, by 64-bit hashes
    of the keys, so what is sent has a fixed size for each; a join with the batch
    then shuffles only what can match. With more keys the table is returned as it
    is; the join gives the same rows either way.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    typed = [F.col(k).cast(stored.schema[k].dataType) for k in keys]
    ids, few = pin_small(
        batch.dropna(subset=keys).select(F.xxhash64(*typed).alias("__key")).distinct(), max_rows)
    if not few:
        return stored
    own = stored.dropna(subset=keys)
    return own.join(F.broadcast(ids), F.xxhash64(*keys) == F.col("__key"), "left_semi").select(*stored.columns)


def hot_keys(df, keys, rows_per_task=None):
    """Every key with more than `rows_per_task` rows and the salts it gets.

    Only the key columns are read, and counts are combined before the shuffle.
    """
    rows_per_task = rows_per_task or _setting(df, "hotRowsPerTask", HOT_ROWS_PER_TASK)
    return (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("__rows"))
        .where(F.col("__rows") > rows_per_task)
        .select(*keys, F.ceil(F.col("__rows") / rows_per_task).cast("int").alias("__salts"))
    )


def _spread_columns(left, on, spread):
    """Columns that tell the rows of one key apart."""
    if spread is None:
        spread = [f.name for f in left.schema.fields if f.name not in on and f.dataType.typeName() != "map"]
    spread = [spread] if isinstance(spread, str) else list(spread)
    if not set(spread) - set(on):
        raise ValueError(f"rows of one key can't be dealt by the key itself: spread {spread}, keys {on}")
    return spread


def skew_join(left, right, on, how, spread=None, *, hot_from=None, rows_per_task=None,
              small_limit=None):
    """Equi-join whose left side may hold very many rows of one key.

    `how` is inner, left, left_semi or left_anti. Rows of a hot key are dealt over salts
    by a hash of the `spread` columns (default: all others); right rows of a hot key
    are repeated once per salt, so every left row still meets all its partners
    exactly once. Rows with a null key have no partner and stay out of the join.

    Spark's own skew join splits a side only where both sides come straight from
    a shuffle; use this one where the right side was grouped by the key before.
    Hot keys are counted on `hot_from` (default: left), which should be a stored
    table: only its key columns are read. More hot keys than are pinned are
    stored and joined by a shuffle that Spark's own skew join can split.
    """
    on = [on] if isinstance(on, str) else list(on)
    spread = _spread_columns(left, on, spread)
    if is_small(left, small_limit):
        return left.join(right, on, how)
    hot, few = pin_small(hot_keys(left if hot_from is None else hot_from, on, rows_per_task))
    hot = F.broadcast(hot) if few else cut_lineage(hot)
    known = left.dropna(subset=on)
    salted_left = known.join(hot, on, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("__salts")), F.lit(0)).cast("int")
    ).drop("__salts")
    salted_right = right.dropna(subset=on).join(hot, on, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))
    ).drop("__salts")
    joined = salted_left.join(salted_right, on + ["__salt"], how).drop("__salt")
    if how in ("inner", "left_semi"):
        return joined
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    return joined.unionByName(left.where(any_null), allowMissingColumns=True)


def rank_rows(df, group, order, name="rank", *, partitions=None, small_limit=None):
    """Number all rows of each group 1, 2, 3, ... in a total order.

    A plain window puts a whole group into one task. On large input the rows are
    sorted by (group, order) over range partitions instead and take their
    position from there; a row's number is its distance from the first row of
    its group in the range, plus the rows of the group in earlier ranges. The
    rows are shuffled once. The positions are stored, since both the counts and
    the numbers rely on them. `order` must end in a unique key.
    """
    group = [group] if isinstance(group, str) else list(group)
    if is_small(df, small_limit):
        window = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    if partitions is None:
        shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        size = input_bytes(df)
        # Rows from outside (no file) have no known size: Catalyst puts in its largest number.
        partitions = max(shuffles, size // RANK_BYTES_PER_TASK) if size < 2**60 else shuffles
    placed = cut_lineage(
        df.repartitionByRange(partitions, *group, *order).sortWithinPartitions(*group, *order)
        .withColumn("__at", F.monotonically_increasing_id())
    ).withColumn("__range", F.shiftright("__at", _ROW_BITS))
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(*group, "__range")
        .agg(F.count("*").alias("__rows"), F.min("__at").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    )
    keys = [*group, "__range"]
    shifts, few = pin_small(shifts.select(
        *[F.col(k).alias("__o_" + k) for k in keys],
        (F.col("__before") - F.col("__first") + 1).alias("__shift")), RANK_PIN_ROWS)
    matched = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("__o_" + k)) for k in keys])
    return (
        placed.join(F.broadcast(shifts) if few else shifts, matched)
        .select(*df.columns, (F.col("__at") + F.col("__shift")).alias(name))
    )


def number_rows(df, order, name="row_no", **kwargs):
    """`rank_rows` over the whole frame as one group."""
    marked = df.withColumn("__all", F.lit(0))
    return rank_rows(marked, "__all", order, name, **kwargs).drop("__all")


def first_per_key(df, keys, order):
    """One row per key, the first in `order`.

    Spark keeps at most one row per key and map task before the shuffle
    (WindowGroupLimit), so many copies of one key do not meet in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(window))
        .where(F.col("__rn") == 1).drop("__rn")
    )


def top_per_group(df, group, order, k, name="rank"):
    """The first `k` rows of each group with their numbers; pre-limited per map task."""
    group = [group] if isinstance(group, str) else list(group)
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
