"""Relational operators: parsing, quality, topics, graphs, centrality."""

from warbler.operators.centrality import betweenness, node_sizes
from warbler.operators.graph import Graph, mention_edges, topic_mention_graph, undirected_graph
from warbler.operators.quality import bad_record_total, bad_records, record_type_counts
from warbler.operators.topics import (
    distinct_then_drop,
    mention_user_count,
    mention_user_list,
    topic_mention_counts,
    topic_mention_counts_sql,
    topic_users,
    topic_users_sql,
    users_in_both,
    users_in_both_sql,
)
from warbler.operators.tweets import (
    malformed_records,
    marked_records,
    parse_tweets,
    row_counts,
    tweet_table,
)

__all__ = [
    "Graph", "bad_record_total", "bad_records", "betweenness", "distinct_then_drop",
    "malformed_records", "marked_records", "mention_edges", "mention_user_count",
    "mention_user_list", "node_sizes", "parse_tweets", "record_type_counts", "row_counts",
    "topic_mention_counts", "topic_mention_counts_sql", "topic_mention_graph", "topic_users",
    "topic_users_sql", "tweet_table", "undirected_graph", "users_in_both", "users_in_both_sql",
]
