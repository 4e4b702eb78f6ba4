"""Plan shape: no Python in any plan, filters reach the Parquet scan, columns are pruned."""

import pytest

from helpers import SF_SMALL, write_text
from warbler.plans import workloads as W
from warbler.plans.registry import QUERIES
from warbler.plans.workspace import Workspace


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [k for k in QUERIES
                                  if "betweenness" not in k and k != "node_sizes"])
def test_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for node in ("EvalPython", "InPandas", "InArrow", "PythonUDF", "PythonMapInArrow",
                 "FlatMapCoGroups", "WindowInPandas", "AggregateInPandas"):
        assert node not in plan, name


def test_topic_filters_pushed_down(spark):
    tweets = Workspace(spark, SF_SMALL).tweets()
    for df, tag in [(W.users_of_topic(tweets, "Youtube"), "Youtube"),
                    (W.mentions_per_user(tweets, "iranians", "n"), "iranians"),
                    (W.mention_users(tweets, "H1N1"), "H1N1")]:
        plan = _plan(df)
        assert f"EqualTo(hashtag,{tag})" in plan
    plan = _plan(W.rows_per_mention(tweets))
    assert "In(hashtag, [H1N1,Oklahama])" in plan
    plan = _plan(W.users_of_topic(tweets, "Youtube"))
    assert "ReadSchema: struct<username:string,hashtag:string>" in plan


@pytest.mark.parametrize("broadcast_arcs", [0, 1000])
def test_betweenness_rounds_have_no_shuffle(spark, tmp_dir, monkeypatch, broadcast_arcs):
    """What a block sends stays in it, with the arcs as a broadcast or as a table."""
    from warbler.operators import centrality, graph
    from warbler.sources import tables

    path = write_text(f"{tmp_dir}/g.csv", "a,b,1\nb,c,1\nc,d,2\na,d,5\n")
    g = graph.undirected_graph(tables.scan_edge_list(spark, path, keep_order=True), "last")
    plans, cut, add = [], centrality._Cuts.__call__, centrality._Layers.add

    def spy(original):
        def call(self, df):
            if getattr(self, "blocks", True) and "w" not in df.columns and df.columns != ["block", "s"]:
                plans.append((df.columns, _plan(df)))
            return original(self, df)

        return call

    monkeypatch.setattr(centrality._Cuts, "__call__", spy(cut))
    monkeypatch.setattr(centrality._Layers, "add", spy(add))
    monkeypatch.setattr(centrality, "default_parallelism", lambda spark: 3)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        centrality.betweenness(g, broadcast_arcs=broadcast_arcs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert len(plans) > 10
    for columns, plan in plans:
        assert plan.count("Exchange") == plan.count("BroadcastExchange"), (columns, plan)
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert broadcast_arcs or "Broadcast" not in plan
