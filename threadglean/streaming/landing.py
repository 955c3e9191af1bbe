"""Landing files picked up by Structured Streaming instead of by hand.

The reading progress lives in the stream's checkpoint, so a run takes the files
that arrived since the last one and then stops. The stages behind it are those
of the daily run.
"""

from pyspark.sql import functions as F

from threadglean.schemas import LANDING

LISTING = "__listing"


def landing_stream(spark, path, fmt="json"):
    """Listing files as a stream, with the folder of each file as `__listing`.

    A folder is one listing, in any number of files. Write it under another
    name and rename it when it is whole: its cap and the marks count on all files
    being there when they are read.
    """
    entries = spark.readStream.schema(LANDING).format(fmt).option("recursiveFileLookup", "true").load(path)
    return entries.withColumn(LISTING, F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1))


def ingest_available(run, path, checkpoint, fmt="json"):
    """Ingest and clean all files that are not taken yet; returns when done.

    All files that wait make one batch, so the marks move only after whole listings.
    A batch that is delivered again after a failure adds nothing twice: raw posts
    and comments are merged by key, and posts, whose times are the mark, are written last.
    """

    def stages(batch, _):
        run.ingest(batch, by=[LISTING])
        run.preprocess()

    query = (
        landing_stream(run.tables.spark, path, fmt).writeStream.foreachBatch(stages)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
