"""Log metrics kept by a stream against those of one batch over all lines."""

import random

from pyspark.sql import functions as F

from threadglean.operators import runmetrics, scale
from threadglean.streaming import logs
from tests.helpers import rows


def lines_of(rng, marker_lines, n):
    out = []
    for i in range(n):
        stamp = f"[2025-01-09T0{rng.randrange(10)}:1{rng.randrange(10)}:00.{rng.randrange(1000):03d}+0000] "
        out.append((stamp if rng.random() < 0.8 else "") + rng.choice(marker_lines).replace("#", str(i)))
    return out


MARKERS = {
    "ingest_preprocess": ["Starting attempt", "Task exited with return code 0", "Successfully processed post #",
                          "Processing complete. Total new summaries added: #", "nothing"],
    "report": ["Analyzing data for subreddit: x", "Output saved to f#.md", "nothing"],
    "join": ["Finished running 1 table model in # seconds (#.5s)", "Completed successfully"],
}


def write(root, delivery, task, attempt, lines):
    folder = root / f"delivery={delivery}/dag_id=d/run_id=r 1/task_id={task}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"attempt={attempt}.log").write_text("".join(x + "\n" for x in lines))


def test_deliveries_equal_one_batch(spark, tmp_path):
    rng = random.Random(2)
    landed, whole = tmp_path / "landed", []
    number = 0
    for delivery in (1, 2, 3):
        for task, markers in MARKERS.items():
            for attempt in (1, 2) if delivery < 3 else (2, 3):
                lines = lines_of(rng, markers, rng.randrange(0, 9))
                write(landed, delivery, task, attempt, lines)
                for line in lines or [""]:
                    number += 1
                    whole.append(("d", "r 1", task, attempt, number, line))
        for task in MARKERS:
            logs.collect_metrics(spark, str(landed), task, [task], str(tmp_path / "m"), str(tmp_path / "c"))
    every = spark.createDataFrame(
        whole, "dag_id string, run_id string, task_id string, attempt int, line_no long, value string")
    for task in MARKERS:
        want = runmetrics.extract_metrics(every.where(F.col("task_id") == task), runmetrics.EXTRACTORS[task])
        got = logs.stored_metrics(spark, str(tmp_path / "m"), task)
        assert rows(got.select(*want.columns)) == rows(want)


def test_only_new_files_are_read(spark, tmp_path):
    landed, at = tmp_path / "landed", (str(tmp_path / "m"), str(tmp_path / "c"))
    write(landed, 1, "report", 1, ["[2025-01-09T01:00:00.000+0000] Analyzing data for subreddit: x"])
    logs.collect_metrics(spark, str(landed), "report", ["report"], *at)
    (landed / "delivery=1/dag_id=d/run_id=r 1/task_id=report/attempt=1.log").write_text("changed\n" * 9)
    write(landed, 2, "report", 2, ["[2025-01-09T01:00:00.000+0000] Output saved to f.md"])
    logs.collect_metrics(spark, str(landed), "report", ["report"], *at)
    got = {r.attempt: (r.subreddits_processed, r.outputs_generated)
           for r in logs.stored_metrics(spark, at[0], "report").collect()}
    assert got[2] == (0, 1) and got[1][1] == 0
    batches = sorted(r.batch for r in spark.read.parquet(at[0] + "/kind=report").select("batch").distinct().collect())
    assert batches == [0, 1]


def test_scratch_folders_go_with_their_block(spark):
    import os

    with scale.stored_copies():
        path = scale.scratch_folder(spark, "some").removeprefix("file:")
        os.makedirs(path)
    assert not os.path.exists(path)
