"""Sharding (2) by proportional stratified interleaving, with DataFrame functions only.

Rows are ranked in a seeded random order within their source; sorted by their
fractional rank (rank - 1/2) / rows of the source, every stretch of the whole
sequence holds each source in proportion. Cutting it into equal stretches gives
shards that match the mixture and differ by one row at most.
"""

from pyspark.sql import functions as F

from threadglean.operators.scale import number_rows, pin_small, rank_rows


def assign_shards(rows, shards=8, *, source_col="source", order_cols=("doc_id",), seed=17):
    """All rows with `shard` (0 to shards - 1) and `slot` (from 0, without gaps, in a shard).

    `order_cols` identify a row; rows that agree in all of them are
    interchangeable, each gets a place of its own. A null source is a source. Columns named
    `shard` or `slot` are replaced. Both rankings sort ranges, so a source may
    hold any share of the rows, and store the rows once each: hand over slim
    rows and join them to the texts where texts aren't needed for the cut. Texts and null ids
    are columns like others. An empty table gives an empty one.
    """
    rows = rows.drop("shard", "slot")
    columns = rows.columns
    order = ["__deal", *[F.col(c) for c in order_cols]]
    dealt = rows.withColumn("__deal", F.xxhash64(F.lit(seed), *order_cols))
    ranked = rank_rows(dealt, source_col, order, "__rank", small_limit=0)
    sizes = rows.groupBy(F.col(source_col).alias("__source")).agg(F.count("*").alias("__n"))
    total = rows.count()
    sizes, few = pin_small(sizes)
    placed = (
        ranked.join(F.broadcast(sizes) if few else sizes,
                    F.col(source_col).eqNullSafe(F.col("__source")))
        .withColumn("__part", (F.col("__rank") - 0.5) / F.col("__n"))
    )
    tie = F.xxhash64(F.lit(seed), F.col(source_col))
    cut = number_rows(placed, ["__part", tie, F.col(source_col), "__rank"], "__pos", small_limit=0)
    # Shard s holds the positions p with p * shards div total = s.
    begin = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return (
        cut.withColumn("shard", F.expr(f"((__pos - 1) * {shards}) div {max(total, 1)}").cast("int"))
        .withColumn("slot", F.col("__pos") - 1 - begin)
        .select(*columns, "shard", "slot")
    )


def write_shards(rows, path):
    """One folder per shard, rows in slot order over one or more files."""
    (rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def text_size(text):
    """UTF-8 bytes plus 1; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text):
    """Unsigned crc32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
