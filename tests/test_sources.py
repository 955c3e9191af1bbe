import datetime as dt

import pytest

from threadglean.schemas import TABLES
from threadglean.sources import jdbc
from threadglean.sources.tables import DuplicateKey, Tables
from tests.helpers import rows


def test_tables(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    assert t.read("posts").schema == TABLES["posts"] and t.read("posts").count() == 0
    batch = spark.createDataFrame(
        [("p1", "a", "t", "x", "u", 1, dt.datetime(2025, 1, 1)), ("p2", "b", "t", "x", "u", 1, None)],
        TABLES["posts"])
    t.append("posts", batch)
    assert rows(t.read("posts")) == rows(batch)
    assert t.read("posts").columns == TABLES["posts"].names
    for bad in (batch.limit(1), batch.where("false").unionByName(batch.withColumn("post_id", batch.url))):
        with pytest.raises(DuplicateKey):
            t.append("posts", bad)
    t.replace("posts", t.read("posts").where("post_id = 'p2'"))
    assert [r.post_id for r in t.read("posts").collect()] == ["p2"]
    assert t.path("posts").endswith("v=2")


def test_day_folders_are_skipped(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    days = [dt.datetime(2025, 1, d, 12) for d in (1, 2, 3)]
    t.append("posts", spark.createDataFrame(
        [(f"p{d.day}", "a", "t", "x", "u", 1, d) for d in days] + [("p0", "a", "t", "x", "u", 1, None)],
        TABLES["posts"]))
    late = t.read("posts", dt.datetime(2025, 1, 2, 15))
    assert sorted(r.post_id for r in late.collect()) == ["p2", "p3"]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_day" in plan
    assert t.read("posts").count() == 4
    for _ in range(3):
        t.replace("posts", late)
    t.drop_old_versions("posts")
    assert t.read("posts").count() == 2 and not (tmp_path / "posts" / "v=2").exists()


def test_unfinished_version_is_ignored(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t.append("update_processing_status", spark.createDataFrame(
        [("c", "p")], TABLES["update_processing_status"]))
    (tmp_path / "update_processing_status" / "v=2").mkdir()
    assert t.path("update_processing_status").endswith("v=1")


def test_create_missing(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    t.create_missing()
    t.create_missing()
    assert all(t.path(name).endswith("v=1") and t.read(name).isEmpty() for name in TABLES)


def test_jdbc_options():
    conn = jdbc.connection("jdbc:x", user="u")
    assert conn == {"url": "jdbc:x", "user": "u"}
    split = jdbc.scan_options("t", "id", 0, 100, 8)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "8")
    assert "partitionColumn" not in jdbc.scan_options("t")
    with pytest.raises(ValueError):
        jdbc.scan_options("t", "id")
    assert jdbc.new_rows_query("t", 1736380800.5) == (
        "(SELECT t.* FROM t t WHERE EXTRACT(EPOCH FROM t.created_utc) > 1736380800.5) unread")
    assert "FROM created_utc" in jdbc.mark_query("t")


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    from pyspark.sql import functions as F

    t, name = Tables(spark, str(tmp_path)), "text_summary_results"
    order = [F.asc("comment_summary")]

    def batch(pairs):
        return spark.createDataFrame(pairs, TABLES[name])

    def files():
        return {str(p.relative_to(tmp_path)) for p in (tmp_path / name).rglob("*.parquet")}

    t.upsert(name, batch([(f"c{i}", f"old {i}") for i in range(500)]), order)
    before = files()
    t.upsert(name, batch([("c7", "z new"), ("c7", "new"), ("d1", "added")]), order)
    got = dict((r.comment_id, r.comment_summary) for r in t.read(name).collect())
    assert len(got) == 501 and got["c7"] == "new" and got["d1"] == "added" and got["c8"] == "old 8"
    bucket = spark.sql("SELECT pmod(xxhash64('c7'), 64) AS b").first().b
    gone = before - files()
    assert gone and all(f"key_bucket={bucket}/" in f for f in gone)


def test_replaced_folders_survive_a_crash(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    t, name = Tables(spark, str(tmp_path)), "daily_summary_data"
    days = [dt.datetime(2025, 1, d, 12) for d in (1, 2)]
    table = spark.createDataFrame(
        [(d.day, "a", f"p{d.day}", 1, "u", f"c{d.day}", d.date(), d, True, "t", "b") for d in days], TABLES[name])
    t.append(name, table)
    flipped = t.read(name).where("id = 1").withColumn("needs_processing", F.lit(False))
    write = Tables._write
    with monkeypatch.context() as m:
        def broken(self, df, *args, **options):
            # The folder to replace is gone, its new rows are not in place.
            import shutil

            shutil.rmtree(f"{self.path(name)}/processed_day=2025-01-01")
            raise OSError("killed")
        m.setattr(Tables, "_write", broken)
        with pytest.raises(OSError):
            t.replace_partitions(name, flipped)
    assert Tables._write is write
    assert sorted((r.id, r.needs_processing) for r in t.read(name).collect()) == [(1, False), (2, True)]
    assert not (tmp_path / name / "pending").exists()


def test_last_folders_hold_the_largest_times(spark, tmp_path):
    t = Tables(spark, str(tmp_path))
    times = [(c, dt.datetime(2025, 1, d, 12)) for c, ds in (("a", (1, 2, 3)), ("b", (1, 5)), ("c", ())) for d in ds]
    t.append("posts", spark.createDataFrame(
        [(f"{c}{d.day}", c, "t", "x", "u", 1, d) for c, d in times] + [("n", "c", "t", "x", "u", 1, None)],
        TABLES["posts"]))
    last = t.read_last("posts")
    assert sorted(r.post_id for r in last.collect()) == ["a3", "b5"]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "created_day" in plan.split("PartitionFilters: [")[1]


def test_stored_copies_go_with_their_block(spark):
    import os

    from threadglean.operators import scale

    with scale.stored_copies():
        kept = scale.cut_lineage(spark.range(5))
        path = kept.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(path) and kept.count() == 5
    assert not os.path.exists(path)
