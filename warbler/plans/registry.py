"""Named queries: each takes (spark, data_dir) and returns a DataFrame over the whole input.

Keys for sources and sinks write to a fresh path under the shared checkpoint folder and read the
result back, so the round trip itself is what is compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warbler.functions import record as R
from warbler.operators import centrality, graph, quality, topics, tweets
from warbler.plans import workloads as W
from warbler.plans.workspace import Workspace
from warbler.session import scratch_path
from warbler.sources import lists, sinks, tables
from warbler.sources.tables import TWEET_SCHEMA

# The topic whose mention graph is analysed (fixed value of the graph questions).
GRAPH_TOPIC = "H1N1"

Query = Callable[[SparkSession, str], DataFrame]


def _ws(spark: SparkSession, data_dir: str) -> Workspace:
    return Workspace(spark, data_dir)


# --- sources -----------------------------------------------------------------------------------

def scan_records(spark, d):
    return _ws(spark, d).records()


def scan_header_record(spark, d):
    records = _ws(spark, d).records()
    return records.filter(R.is_header("value")).select(
        "value", R.message_text("value").alias("message"))


def scan_parquet(spark, d):
    return _ws(spark, d).tweets()


def _topic_edge_file(spark, d) -> str:
    return _ws(spark, d).topic_edges_path(GRAPH_TOPIC)


def scan_edge_list(spark, d):
    return tables.scan_edge_list(spark, _topic_edge_file(spark, d))


def typed_tweet_table(spark, d):
    return tweets.tweet_table(_ws(spark, d).records()).to(TWEET_SCHEMA)


def temp_view_sql(spark, d):
    with W.views(spark, _ws(spark, d).tweets()) as (view,):
        return spark.sql(f"SELECT username, hashtag, mention FROM {view}")


# --- sinks -------------------------------------------------------------------------------------

def sink_parquet(spark, d):
    path = sinks.write_parquet(W.mention_users(_ws(spark, d).tweets()),
                               scratch_path(spark, "mention-users-parquet"))
    return spark.read.parquet(path)


def sink_csv(spark, d):
    # The original wrote one part file through a single task; the lists grow with the data, so
    # every task writes its share here and readers take the folder.
    path = sinks.write_csv(W.mention_users(_ws(spark, d).tweets()),
                           scratch_path(spark, "mention-users-csv"))
    return spark.read.schema("mention string, usernames string").csv(path)


def sink_text_pairs(spark, d):
    path = W.bad_record_report(_ws(spark, d).records(), scratch_path(spark, "record-types"))
    return spark.read.text(path)


def sink_edge_list(spark, d):
    return spark.read.text(_topic_edge_file(spark, d))


def row_counts(spark, d):
    return tweets.row_counts(_ws(spark, d).records())


# --- projections, filters, scalar functions ------------------------------------------------------

def prefilter_marked(spark, d):
    return tweets.marked_records(_ws(spark, d).records())


def message_text(spark, d):
    return _ws(spark, d).records().select("value", R.message_text("value").alias("message"))


def parse_username(spark, d):
    return _ws(spark, d).records().select("value", R.username("value").alias("username"))


def _positions(spark, d, fn, name):
    return (_ws(spark, d).records()
            .select("value", F.posexplode(fn("value")).alias("pos", name))
            .select("value", F.col("pos").cast("long").alias("pos"), name))


def parse_mentions(spark, d):
    return _positions(spark, d, R.mentions, "mention")


def parse_hashtags(spark, d):
    return _positions(spark, d, R.hashtags, "hashtag")


def parse_tweets(spark, d):
    return tweets.parse_tweets(_ws(spark, d).records()).select(
        "value", "username",
        F.array_join("mentions", ",").alias("mentions"),
        F.array_join("hashtags", ",").alias("hashtags"))


def tweet_table(spark, d):
    return tweets.tweet_table(_ws(spark, d).records())


def malformed_records(spark, d):
    return tweets.malformed_records(_ws(spark, d).records()).agg(
        F.count(F.lit(1)).alias("malformed_records"))


# --- topic questions ---------------------------------------------------------------------------

def topic_users_df(spark, d):
    return W.users_of_topic(_ws(spark, d).tweets(), "Youtube")


def topic_users_sql(spark, d):
    with W.views(spark, _ws(spark, d).tweets()) as (view,):
        return topics.topic_users_sql(spark, view, "Youtube")


def topic_mentions_iranelections(spark, d):
    return W.mentions_per_user(_ws(spark, d).tweets(), *W.IRAN_ELECTIONS)


def topic_mentions_iranians(spark, d):
    return W.mentions_per_user(_ws(spark, d).tweets(), *W.IRANIANS)


def topic_join_df(spark, d):
    return W.users_in_two_topics_joined(_ws(spark, d).tweets())


def topic_join_one_scan(spark, d):
    return W.users_in_two_topics(_ws(spark, d).tweets())


def topic_join_sql(spark, d):
    return W.users_in_two_topics_sql(spark, _ws(spark, d).tweets())


def topic_join_top100(spark, d):
    return topic_join_sql(spark, d).orderBy("username").limit(100)


def distinct_then_drop(spark, d):
    return topics.distinct_then_drop(_ws(spark, d).tweets(), "H1N1")


def mention_user_count(spark, d):
    return W.rows_per_mention(_ws(spark, d).tweets())


def mention_user_list(spark, d):
    return W.mention_users(_ws(spark, d).tweets(), "H1N1")


def mention_user_slices(spark, d):
    """The slices' content: where they are cut follows the data's ranges, not the question."""
    slices = W.mention_user_slices(_ws(spark, d).tweets(), "H1N1")
    return slices.select("mention", F.explode(F.split("usernames", ",")).alias("username"))


def mention_user_list_files(spark, d):
    """The lists as files with offsets, by name: their whole sizes."""
    slices = W.mention_user_slices(_ws(spark, d).tweets(), "H1N1")
    path = lists.write_user_lists(slices, scratch_path(spark, "mention-user-lists"))
    return lists.list_sizes(spark, path).select("mention", "list_bytes")


# --- quality -----------------------------------------------------------------------------------

def bad_record_total(spark, d):
    return quality.bad_record_total(_ws(spark, d).records())


def record_type_counts(spark, d):
    return quality.record_type_counts(_ws(spark, d).records())


def bad_records(spark, d):
    return quality.bad_records(_ws(spark, d).records())


def has_hashtag(spark, d):
    return _ws(spark, d).records().select(
        "value", R.has_hashtag("value", GRAPH_TOPIC).cast("long").alias("has_hashtag"))


# --- graphs ------------------------------------------------------------------------------------

def mention_edges(spark, d):
    return graph.mention_edges(_ws(spark, d).records())


def topic_mention_graph(spark, d):
    return graph.topic_mention_graph(_ws(spark, d).records(), GRAPH_TOPIC)


def _topic_graph(spark, d) -> graph.Graph:
    edges = tables.scan_edge_list(spark, _topic_edge_file(spark, d), keep_order=True)
    return graph.undirected_graph(edges, on_duplicate="last")


def graph_edges(spark, d):
    return _topic_graph(spark, d).arcs


def graph_nodes(spark, d):
    return _topic_graph(spark, d).nodes


def _rounded(scores: DataFrame) -> DataFrame:
    """Sums of doubles in no fixed order, to what is compared."""
    return scores.withColumns({c: F.round(c, n) for c, n in (("betweenness", 9), ("node_size", 5))
                               if c in scores.columns})


def _betweenness(edges: graph.Graph) -> DataFrame:
    return centrality.betweenness(edges, held_arcs=centrality.HELD_ARCS, hub_arcs=centrality.HUB_ARCS)


def betweenness(spark, d):
    return _rounded(_betweenness(_topic_graph(spark, d)))


def node_sizes(spark, d):
    return _rounded(centrality.node_sizes(_betweenness(_topic_graph(spark, d))))


def _event_graph(spark, d) -> graph.Graph:
    """Repeated, reversed and self edges: the last line of a pair counts."""
    edges = tables.scan_edge_list(spark, _ws(spark, d).event_edges_path(), keep_order=True)
    return graph.undirected_graph(edges, on_duplicate="last")


def event_graph_edges(spark, d):
    return _event_graph(spark, d).arcs


def event_graph_nodes(spark, d):
    return _event_graph(spark, d).nodes


def event_graph_betweenness(spark, d):
    return _rounded(_betweenness(_event_graph(spark, d)))


QUERIES: dict[str, Query] = {
    name: globals()[name]
    for name in [
        "scan_records", "scan_header_record", "scan_parquet", "scan_edge_list",
        "typed_tweet_table", "temp_view_sql",
        "sink_parquet", "sink_csv", "sink_text_pairs", "sink_edge_list", "row_counts",
        "prefilter_marked", "message_text", "parse_username", "parse_mentions", "parse_hashtags",
        "parse_tweets", "tweet_table", "malformed_records",
        "topic_users_df", "topic_users_sql", "topic_mentions_iranelections",
        "topic_mentions_iranians", "topic_join_df", "topic_join_one_scan",
        "topic_join_sql", "topic_join_top100",
        "distinct_then_drop", "mention_user_count", "mention_user_list",
        "bad_record_total", "record_type_counts", "bad_records", "has_hashtag",
        "mention_edges", "topic_mention_graph", "graph_edges", "graph_nodes",
        "betweenness", "node_sizes", "mention_user_slices",
        "mention_user_list_files",
        "event_graph_edges", "event_graph_nodes", "event_graph_betweenness",
    ]
}
