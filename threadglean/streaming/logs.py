"""Metrics of task logs as a stream (S7, L1-L8): only files that are new are read.

The aggregates of `runmetrics.extract_metrics` (counts, last and first values by line) are
kept as the state of a streaming aggregation per attempt, so a later delivery of
lines of the same attempt goes on where the first one ended. Each micro-batch stores the
attempts that changed; the last stored row of an attempt is its metrics.
"""

from pyspark.sql import functions as F

from threadglean.operators import runmetrics, scale

_KEYS = {"dag_id": "string", "run_id": "string", "task_id": "string", "attempt": "int"}


def task_log_stream(spark, root, max_files=None):
    """Lines of log files as a stream: dag_id, run_id, task_id, attempt, line_no, value.

    The keys come from the path, as in `sources.files.read_task_logs`. An attempt may come in
    several files; their names order them, so `line_no` is the file and the place in it. A file is
    read once and whole: write it under another name and rename it, and rotate long logs.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    keys = [F.regexp_extract(path, rf"/{k}=([^/]+?)(?:\.[A-Za-z]+)?(?:/|$)" if k == "attempt" else rf"/{k}=([^/]+)/", 1)
            .cast(kind).alias(k) for k, kind in _KEYS.items()]
    lines = F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n"))
    named = reader.text(root, wholetext=True).select(*keys, path.alias("file"), lines.alias("place", "value"))
    place = F.lpad(F.col("place").cast("string"), 10, "0")
    return named.select(*_KEYS, F.concat("file", F.lit(":"), place).alias("line_no"), "value")


def collect_metrics(spark, root, kind, tasks, store, checkpoint, max_files=None):
    """Take the log files of `tasks` that are new into the metrics stored under `store`; returns
    when all are taken.

    A micro-batch that is delivered again after a failure replaces its own rows.
    """
    lines = task_log_stream(spark, root, max_files).where(F.col("task_id").isin(list(tasks)))
    metrics = runmetrics.extract_metrics(lines, runmetrics.EXTRACTORS[kind])

    def put(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{store}/kind={kind}/batch={batch_id}")

    query = (metrics.writeStream.outputMode("update").foreachBatch(put)
             .option("checkpointLocation", f"{checkpoint}/{kind}").trigger(availableNow=True).start())
    query.awaitTermination()


def stored_metrics(spark, store, kind):
    """The metrics of every attempt that was ever taken, as of its last lines."""
    rows = spark.read.parquet(f"{store}/kind={kind}")
    return scale.first_per_key(rows, runmetrics.RUN_KEYS, [F.desc("batch")]).drop("batch")
