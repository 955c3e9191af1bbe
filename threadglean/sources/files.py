"""File sources and sinks: landing entries, task logs, report text."""

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from threadglean import constants as K
from threadglean.functions.text import clean_line, keeps_line
from threadglean.operators.scale import rank_rows
from threadglean.schemas import LANDING

# One read task sees at most this many lines of one file split.
_LINES_PER_SPLIT = 2**33


def read_landing(spark, path, fmt="json"):
    """Listing entries with the declared schema; files must not be inferred."""
    return spark.read.schema(LANDING).format(fmt).load(path)


def read_task_logs(spark, root):
    """Lines of all attempts: dag_id, run_id, task_id, attempt, line_no, value.

    The keys come from the folder names, the attempt from the file name. Lines of
    a split are read in order and splits of a file are ordered by their offset,
    so `line_no` grows down the file (it has gaps).
    """
    lines = spark.read.text(root)
    number = F.monotonically_increasing_id() % _LINES_PER_SPLIT
    return lines.select(
        F.col("dag_id").cast("string").alias("dag_id"),
        F.col("run_id").cast("string").alias("run_id"),
        F.col("task_id").cast("string").alias("task_id"),
        F.regexp_extract("_metadata.file_path", r"attempt=(\d+)", 1).cast("int").alias("attempt"),
        (F.col("_metadata.file_block_start").cast("decimal(38,0)") * _LINES_PER_SPLIT + number)
        .cast("decimal(38,0)").alias("line_no"),
        "value",
    )


def day_folder(root, day):
    return f"{root}/{day:year=%Y/month=%m/day=%d}"


def write_reports(lines, root, report_date):
    """Report rows as text under year/month/day/subreddit, replacing that day's
    text of the same communities.

    Rows are range-partitioned in reading order, so a large report becomes
    several files whose names in order give its text. The day is part of the
    path and not a column: the writer then finds the rows already sorted by its
    folder column and keeps their order.
    """
    order = ["subreddit", "section", "position", "line_no"]
    ordered = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    (ordered.select("subreddit", F.col("text").alias("value"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("subreddit").text(day_folder(root, report_date)))


# Lines of a report file; a longer report goes on in numbered files.
LINES_PER_FILE = 500_000
# Short files that one folder aside gets at most, and files that are renamed at once.
FILES_PER_FOLDER = 100
RENAMES_AT_ONCE = 16


def write_markdown(lines, root, report_date, *, lines_per_file=LINES_PER_FILE):
    """Report rows as Markdown under year/month/day/subreddit: llm_<subreddit>.md, then
    llm_<subreddit>_2.md and so on where a report has more than `lines_per_file` lines.

    Lines are numbered over the whole report first, so each file is sorted and written by one
    task and its size is bounded. Files are written aside by Spark, whose commit leaves
    nothing of failed tasks: a folder holds consecutive files of one report, cut after
    `lines_per_file` rows, so its number and the file's place in it give the file's number. They are
    renamed when all are complete, and a community's folder is put in place of the old one as a whole;
    a failed run leaves the old reports as they are. A re-run replaces the reports of its
    communities and keeps files of other names.
    """
    spark = lines.sparkSession
    order = ["section", "position", "line_no"]
    numbered = rank_rows(lines.select("subreddit", *order, "text"), "subreddit", order, "__no")
    per_folder = max(1, min(FILES_PER_FOLDER, LINES_PER_FILE // lines_per_file))
    placed = numbered.withColumn("folder_no", F.floor((F.col("__no") - 1) / (lines_per_file * per_folder)))
    day = day_folder(root, report_date)
    aside = f"{day}/_aside-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(aside).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def rename(old, new):
        if not fs.rename(path(old), path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    # A number of partitions keeps many short files, which are few bytes, from becoming one task's work.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        (placed.repartition(tasks, "subreddit", "folder_no").sortWithinPartitions("subreddit", "folder_no", "__no")
         .select("subreddit", "folder_no", F.col("text").alias("value"))
         .write.option("maxRecordsPerFile", lines_per_file).partitionBy("subreddit", "folder_no").text(aside))
        communities = [s.getPath().getName() for s in fs.listStatus(path(aside)) if s.isDirectory()]
        with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
            for community in communities:
                fs.mkdirs(path(f"{aside}/fresh/{community}"))
                stem = f"{K.REPORT_FILE_PREFIX}{community.split('=', 1)[1]}"
                moves = []
                for folder in [s.getPath().getName() for s in fs.listStatus(path(f"{aside}/{community}"))]:
                    # One task's files, whose names differ in their place only.
                    parts = fs.listStatus(path(f"{aside}/{community}/{folder}"))
                    first, last = re.split(r"\.c\d+", parts[0].getPath().getName())
                    for place in range(len(parts)):
                        number = int(folder.split("=", 1)[1]) * per_folder + place + 1
                        name = f"{stem}.md" if number == 1 else f"{stem}_{number}.md"
                        moves.append((f"{aside}/{community}/{folder}/{first}.c{place:03d}{last}",
                                      f"{aside}/fresh/{community}/{name}"))
                list(pool.map(lambda move: rename(*move), moves))
        for community in communities:
            own, fresh, old = f"{day}/{community}", f"{aside}/fresh/{community}", f"{aside}/old-{community}"
            others = []
            try:
                if fs.exists(path(own)):
                    rename(own, old)
                    found = fs.listStatus(path(old), spark._jvm.org.apache.hadoop.fs.GlobFilter(_OTHER_NAMES))
                    others = [(f"{old}/{n}", f"{fresh}/{n}") for n in (s.getPath().getName() for s in found)]
                for move in others:
                    rename(*move)
                rename(fresh, own)
            except BaseException:
                if fs.exists(path(old)):
                    for at, to in others:
                        if fs.exists(path(to)):
                            rename(to, at)
                    rename(old, own)
                raise
    finally:
        fs.delete(path(aside), True)


# The names that don't begin with the prefix of reports, as a glob.
_OTHER_NAMES = "{%s}" % ",".join(
    [f"{K.REPORT_FILE_PREFIX[:i]}[^{c}]*" for i, c in enumerate(K.REPORT_FILE_PREFIX)]
    + [K.REPORT_FILE_PREFIX[:i] for i in range(1, len(K.REPORT_FILE_PREFIX))])


def read_report_lines(spark, root, day=None, pattern="*.txt"):
    """Lines of stored reports with their file: subreddit, file_path, line_no, value.

    `day` is a date; only its folder is listed.
    """
    path = root if day is None else day_folder(root, day)
    reader = spark.read.option("pathGlobFilter", pattern).option("basePath", root)
    number = F.monotonically_increasing_id() % _LINES_PER_SPLIT
    return reader.text(path).select(
        "subreddit", F.col("_metadata.file_path").alias("file_path"),
        (F.col("_metadata.file_block_start").cast("decimal(38,0)") * _LINES_PER_SPLIT + number)
        .cast("decimal(38,0)").alias("line_no"),
        "value")


def clean_report_lines(lines, column="value"):
    """Cleaned lines, without those that only become empty through cleaning.

    Works line by line, so a report of any size is cleaned in parallel and in
    place; `clean_markdown` is the same rule on one text.
    """
    return lines.where(keeps_line(F.col(column))).withColumn(column, clean_line(column))


def read_markdown(spark, root, pattern=f"{K.REPORT_FILE_PREFIX}*.md"):
    """Whole Markdown files of a day's folder: file_path, text. `write_markdown` bounds their size."""
    return spark.read.option("pathGlobFilter", pattern).text(root, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))


def read_markdown_reports(spark, root, day):
    """The reports of a day as written by `write_markdown`: subreddit, file_no, text of each file."""
    name = F.regexp_extract("file_path", r"([^/]*)\.md$", 1)
    files = read_markdown(spark, day_folder(root, day))
    number = F.regexp_extract("file_path", r"_(\d+)\.md$", 1)
    folder = F.url_decode(F.replace(F.regexp_extract("file_path", r"/subreddit=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    numbered = name != F.concat(F.lit(K.REPORT_FILE_PREFIX), folder)
    return files.select(
        folder.alias("subreddit"), F.when(numbered & (number != ""), number.cast("int")).otherwise(1).alias("file_no"),
        "text")
