"""The large-input ways give the same rows as the plain ones."""

import pytest
from pyspark.sql import functions as F

from threadglean.operators import scale
from tests.helpers import rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a tenth a null key."""
    n = F.col("id")
    return spark.range(3000).select(
        n.alias("row_id"),
        F.when(n % 10 == 0, None).when(n % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (n % 50).cast("string"))).alias("key"),
        (n * 7 % 5).alias("score"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, skewed, how):
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4), (None, 5), ("none", 6)], "key string, v int")
    plain = skewed.join(right, "key", how)
    salted = scale.skew_join(skewed, right, "key", how, "row_id", rows_per_task=100, small_limit=0)
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_hot_rows_are_spread(spark, skewed):
    hot = scale.hot_keys(skewed, ["key"], rows_per_task=100)
    assert rows(hot) == [("hot", 9)]
    right = spark.createDataFrame([("hot", 1)], "key string, v int")
    joined = scale.skew_join(skewed, right, "key", "inner", "row_id", rows_per_task=100, small_limit=0)
    assert joined.count() == skewed.where("key = 'hot'").count()


def test_skew_join_on_two_keys(spark, skewed):
    right = skewed.where("score < 3").select("key", "score").distinct().withColumn("v", F.lit(1))
    plain = skewed.join(right, ["key", "score"], "left")
    salted = scale.skew_join(skewed, right, ["key", "score"], "left", "row_id",
                             rows_per_task=50, small_limit=0)
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("partitions", [1, 7])
def test_rank_rows_equals_window(spark, skewed, partitions):
    order = [F.desc("score"), F.asc("row_id")]
    plain = scale.rank_rows(skewed, "key", order)
    spread = scale.rank_rows(skewed, "key", order, partitions=partitions, small_limit=0)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_number_rows(spark, skewed):
    got = scale.number_rows(skewed, [F.asc("row_id")], partitions=5, small_limit=0)
    assert all(r["row_no"] == r["row_id"] + 1 for r in got.collect())
    assert got.columns == [*skewed.columns, "row_no"]


def test_pin_small_checks_the_size(spark):
    df = spark.range(20)
    assert scale.pin_small(df, 20)[1] is True
    same, ok = scale.pin_small(df, 19)
    assert ok is False and same is df


def test_lookup_join_past_the_limit(spark, skewed):
    right = skewed.where("key IS NOT NULL").groupBy("key").agg(F.max("row_id").alias("last"))
    small = scale.lookup_join(skewed, right, "key", spread="row_id")
    large = scale.lookup_join(skewed, right, "key", spread="row_id", max_rows=3)
    assert rows(large) == rows(small)


def test_keyed_picks(spark, skewed):
    first = scale.first_per_key(skewed, ["key"], [F.desc("row_id")])
    want = skewed.groupBy("key").agg(F.max("row_id").alias("row_id"))
    assert rows(first.select("key", "row_id")) == rows(want)
    top = scale.top_per_group(skewed, "key", [F.asc("row_id")], 3)
    assert top.where("key = 'hot'").count() == 3


def test_top_per_group_limits_before_the_shuffle(skewed):
    plan = scale.top_per_group(skewed, "key", [F.asc("row_id")], 3)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("Exchange") < physical.rindex("WindowGroupLimit")


def test_narrow_to(spark, skewed):
    batch = spark.createDataFrame([("hot",), ("hot",), (None,), ("none",)], "key string")
    few = scale.narrow_to(skewed, batch, "key")
    assert rows(few) == rows(skewed.where("key = 'hot'"))
    assert scale.narrow_to(skewed, batch, "key", max_rows=1) is skewed
    narrow = spark.createDataFrame([(7,), (8,)], "row_id int")  # another type than the stored key
    assert scale.narrow_to(skewed, narrow, "row_id").count() == 2


def test_every_hot_key_is_split(spark):
    """More hot keys than are pinned; null keys stay out and come back."""
    n = F.col("id")
    left = spark.range(12_000).select(
        n.alias("row_id"), F.when(n % 40 == 0, None).otherwise(n % 1500).alias("key"))
    right = spark.range(0, 1500, 2).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = scale.skew_join(left, right, "key", how, rows_per_task=2, small_limit=0)
        assert rows(got) == rows(left.join(right, "key", how))
    assert scale.hot_keys(left, ["key"], 2).count() == 1500


def test_hot_keys_past_the_pin_limit(spark, skewed, monkeypatch):
    monkeypatch.setattr(scale.pin_small, "__defaults__", (1,))
    right = spark.createDataFrame([("hot", 1), ("k1", 3), (None, 5)], "key string, v int")
    got = scale.skew_join(skewed, right, "key", "left", "row_id", rows_per_task=10, small_limit=0)
    assert rows(got) == rows(skewed.join(right, "key", "left"))


def test_rows_are_not_spread_by_the_key(spark, skewed):
    with pytest.raises(ValueError, match="key itself"):
        scale.skew_join(skewed, skewed, "key", "left_semi", "key")


def test_hot_harmful_key_fills_the_tasks(spark):
    """4,000 rows of one key: the slowest of 16 tasks gets at most twice the median."""
    from threadglean.operators.report import flag_harmful

    table = spark.range(4000).select(F.lit("c1").alias("comment_id"), F.col("id").alias("post_id"))
    bad = spark.createDataFrame([("c1",)], "comment_id string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                             "spark.sql.autoBroadcastJoinThreshold")}
    for key, value in zip(before, ("16", "false", "-1")):
        spark.conf.set(key, value)
    try:
        flagged = flag_harmful(table, bad, rows_per_task=50, small_limit=0)
        sizes = sorted(r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 4000 and flagged.where("harmful").count() == 4000
    assert len(sizes) >= 12 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_temporary_folders_of_one_machine_are_known(tmp_path):
    import tempfile

    from threadglean.session import _machine_local

    inside = tempfile.gettempdir() + "/x"
    assert all(_machine_local(p) for p in (inside, "file:" + inside, "file://" + inside))
    assert not any(_machine_local(p) for p in ("hdfs://n/tmp/x", "s3a://tmp/x", "/shared/ckpt", "file:///shared/x"))
