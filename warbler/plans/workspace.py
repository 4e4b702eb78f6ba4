"""Inputs derived from one data directory, built once.

Mirrors the original flow: raw records are written once as a blank-line-delimited text file,
parsed once into the tweet table in Parquet, and every question then reads that Parquet. Records and
tweet table are published in the shared folder under the fingerprint of the events' files, so later
applications start from them; edge lists are the application's own.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from warbler.operators.graph import topic_mention_graph
from warbler.operators.tweets import tweet_table
from warbler.session import app_id, release_scratch, scratch_path
from warbler.sources.events import edges_from_events, records_from_events
from warbler.sources.publish import fingerprint, published
from warbler.sources.records import scan_records, write_records
from warbler.sources.sinks import write_edge_list, write_tweet_table
from warbler.sources.tables import read_tweet_table

_PATHS: dict[tuple[str, str, str], str] = {}


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def release(spark: SparkSession) -> int:
    """Forgets and removes all that was built for this application."""
    for key in [k for k in _PATHS if k[0] == app_id(spark)]:
        del _PATHS[key]
    return release_scratch(spark)


def tweet_copy(spark: SparkSession, records_path: str) -> str:
    """The published tweet table of a record file: parsed by the first application that asks, for as
    long as the file is the same."""
    records = scan_records(spark, records_path)
    return published(spark, "tweet-table", fingerprint(records, "tweet table"),
                     lambda path: write_tweet_table(tweet_table(records), path))


class Workspace:
    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir

    @cached_property
    def version(self) -> str:
        """The events' files as they are now, from their metadata."""
        return fingerprint(self.events(), "records from events")

    def _key(self, name: str) -> tuple[str, str, str]:
        return (app_id(self.spark), f"{self.data_dir}@{self.version}", name)

    def path(self, name: str, build) -> str:
        """A table or file that ``build(path)`` writes, once per application and version."""
        key = self._key(name)
        if key not in _PATHS:
            path = scratch_path(self.spark, name)
            build(path)
            _PATHS[key] = path
        return _PATHS[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(table_path(self.data_dir, name))

    def events(self) -> DataFrame:
        return self.table("events")

    def records_path(self) -> str:
        return published(self.spark, "records", self.version,
                         lambda path: write_records(records_from_events(self.events()), path))

    def records(self) -> DataFrame:
        """Raw records read back through the blank-line text scan."""
        return scan_records(self.spark, self.records_path())

    def tweets_path(self) -> str:
        return tweet_copy(self.spark, self.records_path())

    def topic_edges_path(self, tag: str) -> str:
        """The mention graph of ``#tag`` as an edge list file."""
        return self.path(f"edges-{tag}", lambda path: write_edge_list(
            topic_mention_graph(self.records(), tag), path))

    def event_edges_path(self) -> str:
        """The edge lines of the events as an edge list file."""
        return self.path("event-edges", lambda path: write_edge_list(
            edges_from_events(self.events()), path))

    def tweets(self) -> DataFrame:
        return read_tweet_table(self.spark, self.tweets_path())
