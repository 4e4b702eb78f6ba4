"""Incremental W1: record files arriving in a folder → tweet table in Parquet.

Parsing is stateless, so the batch operators run unchanged on a file stream. Each trigger parses
only the new files. The progress log lives in the folder that ``spark.checkpoint.dir`` names, which
is the same for every application, or where the caller says; so a restarted or re-scheduled query
resumes where it stopped and writes every record exactly once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

import hashlib

from warbler.operators.tweets import tweet_table
from warbler.session import shared_root
from warbler.sources.records import RECORD_SEPARATOR


def default_progress_location(spark: SparkSession, output_dir: str) -> str:
    """Stable per output folder, so a restarted query finds its progress log. A folder set on the
    context won't do: Spark appends a new name to it for each application."""
    root = shared_root(spark)
    if root is None:
        raise ValueError("give checkpoint_location, or set spark.checkpoint.dir for the session")
    key = hashlib.sha1(output_dir.rstrip("/").encode()).hexdigest()[:16]
    return f"{root}/warbler/streams/tweet-table-{key}"


def stream_tweet_table(spark: SparkSession, source_dir: str, output_dir: str,
                       checkpoint_location: str | None = None, available_now: bool = True,
                       max_files_per_trigger: int | None = None,
                       record_sep: str = RECORD_SEPARATOR) -> StreamingQuery:
    """Start the query. ``available_now`` processes what is there, in bounded batches, then
    stops; otherwise it keeps polling the folder."""
    reader = spark.readStream.option("lineSep", record_sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    records = reader.text(source_dir)
    writer = (tweet_table(records).writeStream.format("parquet")
              .option("path", output_dir)
              .option("checkpointLocation",
                      checkpoint_location or default_progress_location(spark, output_dir))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 seconds")
    return writer.start()
