"""Keyed merges: insert-ignore, upsert and the flag update.

There is no in-place MERGE on plain Parquet, so a merge is a new table: the
stored rows that stay, by anti join on the (usually small) batch of keys, plus
the rows of the batch.
"""

from pyspark.sql import functions as F

from threadglean.operators import scale


def one_per_key(new, keys, order=None, unique=False):
    """The batch with null keys rejected and one row per key, the first in `order`.

    Without an order the survivor would be open: that is allowed only if the batch holds
    nothing but its keys, or is known to be `unique`.
    """
    new = new.dropna(subset=list(keys))
    if unique:
        return new
    if order is not None:
        return scale.first_per_key(new, keys, order)
    if set(new.columns) != set(keys):
        raise ValueError(f"rows that share {list(keys)} need an order")
    return new.distinct()


def merge_keyed(old, new, keys, on_match="take_new", *, order=None, unique=False, update_cols=None):
    """Merge a batch into a stored table with unique `keys`.

    on_match="keep_old" ignores batch rows whose key is stored; "take_new"
    replaces stored rows, or only their `update_cols`. `order` says which row
    survives when a key occurs more than once in the batch; `unique` that none does.
    """
    keys = list(keys)
    batch = one_per_key(new, keys, order, unique).select(*old.columns)
    if on_match == "keep_old":
        return old.unionByName(batch.join(old.select(*keys), keys, "left_anti"))
    if on_match != "take_new":
        raise ValueError(f"unknown on_match {on_match!r}")
    if update_cols is not None:
        kept = [c for c in old.columns if c not in keys and c not in update_cols]
        stored = old.select(*keys, F.lit(True).alias("__hit"),
                            *[F.col(c).alias("__o_" + c) for c in kept])
        batch = batch.join(stored, keys, "left").select(*[
            F.when(F.col("__hit"), F.col("__o_" + c)).otherwise(F.col(c)).alias(c)
            if c in kept else F.col(c) for c in old.columns])
    stays = old.join(batch.select(*keys), keys, "left_anti")
    return stays.unionByName(batch)


def insert_ignore(old, new, keys, order=None, unique=False):
    """The first stored version of a key stays for ever."""
    return merge_keyed(old, new, keys, "keep_old", order=order, unique=unique)


def rows_to_insert(old, new, keys, order=None, unique=False):
    """Only what `insert_ignore` would add: the rows to append."""
    keys = list(keys)
    return one_per_key(new, keys, order, unique).join(old.select(*keys), keys, "left_anti").select(*new.columns)


def flag_processed(table, history, **skew):
    """needs_processing becomes false where comment_id occurs in `history`.

    It matches on comment_id alone, whatever the post. Settled rows pass
    untouched; only open ones are joined.
    """
    done = F.col("needs_processing").isNotNull() & ~F.col("needs_processing")
    ids = history.select("comment_id").distinct().withColumn("__hit", F.lit(True))
    open_rows = scale.skew_join(table.where(~done), ids, "comment_id", "left",
                                ["post_id", "comment_id"], **skew)
    flipped = open_rows.withColumn(
        "needs_processing",
        F.when(F.col("__hit"), F.lit(False)).otherwise(F.col("needs_processing")),
    ).select(*table.columns)
    return table.where(done).unionByName(flipped)
