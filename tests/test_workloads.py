"""The composite workloads end to end (the bench runs the same functions)."""

import pytest

from helpers import SF_SMALL, write_text
from warbler.plans import workloads as W
from warbler.plans.workspace import Workspace
from warbler.sources import tables


def test_w1_builds_the_tweet_table(spark, tmp_dir):
    ws = Workspace(spark, SF_SMALL)
    path = W.build_tweet_table(spark, ws.records_path(), f"{tmp_dir}/tweets")
    df = tables.read_tweet_table(spark, path)
    assert df.count() == 918 and df.columns == ["username", "hashtag", "mention"]


def test_w6_writes_parquet_and_csv(spark, tmp_dir):
    lists = W.mention_users(Workspace(spark, SF_SMALL).tweets(), "H1N1")
    pq, csv = W.save_mention_users(lists, f"{tmp_dir}/pq", f"{tmp_dir}/csv")
    a = sorted(tuple(r) for r in spark.read.parquet(pq).collect())
    b = sorted(tuple(r) for r in spark.read.schema("mention string, usernames string").csv(csv).collect())
    assert a == b and len(a) == 78


def test_w7_report_lines(spark, tmp_dir):
    path = W.bad_record_report(Workspace(spark, SF_SMALL).records(), f"{tmp_dir}/report")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["(bad,99)", "(good,901)"]


def test_w8_edge_list_centrality(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/example.csv", "a,b,1.0\na,c,2.0\nb,c,1.5\nb,d,1.7\n")
    got = {r.node: (r.betweenness, r.node_size) for r in W.edge_list_centrality(spark, path).collect()}
    assert got["b"] == (pytest.approx(2 / 3), pytest.approx(5000 * 2 / 3))
    assert got["a"] == got["c"] == got["d"] == (0.0, 0.0)
