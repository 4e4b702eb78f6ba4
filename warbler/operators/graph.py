"""Mention graphs and the undirected simple weighted graph built from an edge list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warbler.functions import record as R


@dataclass(frozen=True)
class Graph:
    """``nodes(node)`` and ``arcs(src, dst, weight)``: every undirected edge in both directions,
    self-loops left out of the arcs (they lie on no shortest path) but their endpoints kept as
    nodes."""

    nodes: DataFrame
    arcs: DataFrame


def _user_mentions(records: DataFrame, value: str) -> DataFrame:
    """(username, mention) per mention; the user is parsed once per record, before the
    explode."""
    v = F.col(value)
    parsed = records.select(R.username(v).alias("username"), R.mentions(v).alias("mentions"))
    return parsed.select("username", F.explode("mentions").alias("mention"))


def _weighted_pairs(user_mentions: DataFrame) -> DataFrame:
    """(username, mention) rows → (src, dst, weight) with src < dst, weight = mention count.
    A hot pair is summed map side before the shuffle."""
    return (user_mentions.filter(F.col("username") != F.col("mention"))
            .groupBy(F.least("username", "mention").alias("src"),
                     F.greatest("username", "mention").alias("dst"))
            .agg(F.count(F.lit(1)).alias("weight")))


def mention_edges(records: DataFrame, value: str = "value") -> DataFrame:
    """Who mentioned whom, as undirected weighted edges, over records that pass the pre-filter
    (the records behind the tweet table). Self-mentions are dropped."""
    return _weighted_pairs(_user_mentions(records.filter(R.is_marked(F.col(value))), value))


def topic_mention_graph(records: DataFrame, tag: str, value: str = "value",
                        match_at_end: bool = False) -> DataFrame:
    """Mention edges of the records that carry ``#tag`` (``has_hashtag``)."""
    return _weighted_pairs(
        _user_mentions(records.filter(R.has_hashtag(F.col(value), tag, match_at_end)), value))


def undirected_graph(edges: DataFrame, on_duplicate: str = "last",
                     order_col: str = "line_order") -> Graph:
    """Undirected simple graph from ``(src, dst, weight)`` rows.

    A pair given more than once, in either direction, keeps the weight of its last line
    (``on_duplicate="last"``, needs ``order_col`` as produced by ``scan_edge_list(keep_order=True)``)
    or the sum (``"sum"``, for derived edges).
    """
    a = F.least("src", "dst").alias("src")
    b = F.greatest("src", "dst").alias("dst")
    if on_duplicate == "last":
        if order_col not in edges.columns:
            raise ValueError(f"on_duplicate='last' needs the line order column {order_col!r}")
        simple = edges.groupBy(a, b).agg(
            F.max_by(F.col("weight").cast("double"), F.col(order_col)).alias("weight"))
    elif on_duplicate == "sum":
        simple = edges.groupBy(a, b).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
    else:
        raise ValueError("on_duplicate must be 'last' or 'sum'")
    nodes = (simple.select(F.col("src").alias("node"))
             .union(simple.select(F.col("dst").alias("node"))).distinct())
    proper = simple.filter(F.col("src") != F.col("dst"))
    arcs = proper.union(proper.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return Graph(nodes=nodes, arcs=arcs)
