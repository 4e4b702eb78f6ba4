"""The composite workloads a user runs, each a DataFrame plan (or a write of one).

W1 build the tweet table          W6 mention → comma-joined users of a topic
W2 users of a topic               W7 bad-record report
W3 mentions per user of a topic   W8 centrality of an edge list
W4 users active in two topics     W9 topic mention graph → edge file → W8
W5 rows per mentioned user for either of two topics
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from warbler.operators import centrality, graph, quality, topics, tweets
from warbler.sources import records as rec
from warbler.sources import sinks, tables

# Topic names and count column names of the original questions (fixed values).
IRAN_ELECTIONS = ("IranElections", "iranElectionsMentionNumber")
IRANIANS = ("iranians", "iraniansMentionNumber")


def build_tweet_table(spark: SparkSession, records_path: str, out_path: str) -> str:
    """W1: record file → tweet table Parquet."""
    return sinks.write_tweet_table(tweets.tweet_table(rec.scan_records(spark, records_path)),
                                   out_path)


def users_of_topic(tweet_df: DataFrame, topic: str = "Youtube") -> DataFrame:
    """W2."""
    return topics.topic_users(tweet_df, topic)


def mentions_per_user(tweet_df: DataFrame, topic: str, alias: str) -> DataFrame:
    """W3."""
    return topics.topic_mention_counts(tweet_df, topic, alias)


def users_in_two_topics(tweet_df: DataFrame, first=IRAN_ELECTIONS, second=IRANIANS) -> DataFrame:
    """W4: per-user mention counts of both topics, of the users that both have, in one scan."""
    return topics.users_in_both_one_scan(tweet_df, first, second)


def users_in_two_topics_joined(tweet_df: DataFrame, first=IRAN_ELECTIONS, second=IRANIANS) -> DataFrame:
    """W4 as a join of the two aggregates (DataFrame form)."""
    return topics.users_in_both(mentions_per_user(tweet_df, *first),
                                mentions_per_user(tweet_df, *second))


def users_in_two_topics_sql(spark: SparkSession, tweet_df: DataFrame, first=IRAN_ELECTIONS,
                            second=IRANIANS) -> DataFrame:
    """W4 (SQL form) over temp views."""
    with views(spark, tweet_df) as (tweet_view,):
        counts = [topics.topic_mention_counts_sql(spark, tweet_view, *t) for t in (first, second)]
    with views(spark, *counts) as (left, right):
        return topics.users_in_both_sql(spark, left, right, first[1], second[1])


@contextmanager
def views(spark: SparkSession, *frames: DataFrame):
    """Temporary views under names of their own, dropped when the block ends; frames made of them
    keep working."""
    names = [f"warbler_{uuid.uuid4().hex}" for _ in frames]
    for name, df in zip(names, frames):
        df.createOrReplaceTempView(name)
    try:
        yield names
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


def rows_per_mention(tweet_df: DataFrame, topic_list: Sequence[str] = ("H1N1", "Oklahama")):
    """W5."""
    return topics.mention_user_count(tweet_df, topic_list)


def mention_users(tweet_df: DataFrame, topic: str = "H1N1") -> DataFrame:
    """W6 (the lists; write them with ``save_mention_users``)."""
    return topics.mention_user_list(tweet_df, topic)


def mention_user_slices(tweet_df: DataFrame, topic: str = "H1N1") -> DataFrame:
    """W6, the distributed form: a name's users in slices, in order."""
    return topics.mention_user_slices(tweet_df, topic)


def save_mention_users(lists: DataFrame, parquet_path: str, csv_path: str) -> tuple[str, str]:
    """W6 sinks: Parquet and CSV at two paths (one path would let the CSV replace the Parquet).
    The lists are computed once; the CSV copy is written from the Parquet files by all tasks."""
    spark = lists.sparkSession
    sinks.write_parquet(lists, parquet_path)
    sinks.write_csv(spark.read.parquet(parquet_path), csv_path)
    return parquet_path, csv_path


def topic_report(tweet_df: DataFrame, out: str) -> str:
    """W2 to W6 over a tweet table, each written as Parquet under ``out``; the user lists as CSV too."""
    lists = f"{out}/mention-users"
    for name, df in (
        ("users", users_of_topic(tweet_df)),
        ("mentions-iranelections", mentions_per_user(tweet_df, *IRAN_ELECTIONS)),
        ("mentions-iranians", mentions_per_user(tweet_df, *IRANIANS)),
        ("users-in-both", users_in_two_topics(tweet_df)),
        ("rows-per-mention", rows_per_mention(tweet_df)),
    ):
        sinks.write_parquet(df, f"{out}/{name}")
    save_mention_users(mention_users(tweet_df), lists, f"{lists}-csv")
    return out


def bad_record_report(records: DataFrame, out_path: str) -> str:
    """W7: (type,count) lines of good and bad records."""
    # Two rows.
    return sinks.write_text_pairs(quality.record_type_counts(records), out_path, single_file=True)


def edge_list_centrality(spark: SparkSession, edge_path: str, **kw) -> DataFrame:
    """W8: edge list file → graph → betweenness → node sizes."""
    g = graph.undirected_graph(tables.scan_edge_list(spark, edge_path, keep_order=True), "last")
    kw.setdefault("held_arcs", centrality.HELD_ARCS)
    kw.setdefault("hub_arcs", centrality.HUB_ARCS)
    return centrality.node_sizes(centrality.betweenness(g, **kw))


def topic_centrality(spark: SparkSession, records: DataFrame, tag: str, edge_path: str,
                     **kw) -> DataFrame:
    """W9: mention graph of ``#tag`` → edge list file → W8."""
    sinks.write_edge_list(graph.topic_mention_graph(records, tag), edge_path)
    return edge_list_centrality(spark, edge_path, **kw)
