"""Jobs as programs, scratch paths, edge-list round trips and records with odd lines."""

import os

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import record, write_text
from warbler import session
from warbler.__main__ import main
from warbler.functions import record as R
from warbler.operators import topics
from warbler.plans import workspace
from warbler.sources import sinks, tables


def test_jobs(spark, tmp_dir):
    records = write_text(f"{tmp_dir}/r.txt", record("a", "x @b #t") + "\n\n" + record("b", "No Post Title"))
    out = main(["tweet-table", records, f"{tmp_dir}/tweets"], spark)
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("a", "t", "b")]
    out = main(["bad-records", records, f"{tmp_dir}/bad"], spark)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["(bad,1)", "(good,1)"]
    edges = write_text(f"{tmp_dir}/e.csv", "a,b,1\nb,c,1\n")
    out = main(["centrality", edges, f"{tmp_dir}/scores"], spark)
    assert {r.node: r.node_size for r in spark.read.parquet(out).collect()} == {"a": 0, "b": 5000, "c": 0}


NAMES = st.text(st.sampled_from('ab ",\\\'é\t'), max_size=6)


@given(st.lists(st.tuples(NAMES, NAMES, st.sampled_from([1.0, 0.1, 2.5])), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_edge_list_round_trip(spark, tmp_dir, edges):
    path = session.scratch_path(spark, "edges")
    sinks.write_edge_list(spark.createDataFrame(edges, "src string, dst string, weight double"), path)
    assert sorted(tuple(r) for r in tables.scan_edge_list(spark, path).collect()) == sorted(edges)


def test_more_fields_and_wrong_weights(spark, tmp_dir):
    path = write_text(f"{tmp_dir}/e.csv", "a,b,1,x,y\nb,c, 2.5 \n")
    assert [tuple(r) for r in tables.scan_edge_list(spark, path).collect()] == [("a", "b", 1.0), ("b", "c", 2.5)]
    path = write_text(f"{tmp_dir}/f.csv", "a,b,one\n")
    with pytest.raises(Exception, match="not a weight"):
        tables.scan_edge_list(spark, path).collect()


def test_empty_lines_around_a_record(spark):
    values = ["T\tx\nU\tu\n", "\nT\tx\nU\tu\nW\tm\n\n", "T\tx\nU\tu\nW\tm", "\n\n", ""]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    assert [r[0] for r in df.select(R.message_text("value")).collect()] == [None, "W\tm", "W\tm", None, None]


def test_slices_make_the_list(spark):
    rows = [(f"u{i:04d}", "t", "hot" if i % 3 else f"m{i % 5}") for i in range(900)] * 2
    df = spark.createDataFrame(rows, "username string, hashtag string, mention string")
    slices = topics.mention_user_slices(df, "t", partitions=9).orderBy("mention", "slice").collect()
    assert sum(r.mention == "hot" for r in slices) > 3
    lists = {}
    for r in slices:
        lists[r.mention] = lists.get(r.mention, []) + r.usernames.split(",")
    want = {}
    for user, _, mention in sorted(set(rows)):
        want.setdefault(mention, []).append(user)
    assert lists == want
    assert {r.mention: r.usernames.split(",") for r in topics.mention_user_list(df, "t").collect()} == want


def test_workspace_follows_its_input(spark, tmp_dir):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.limit(10).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    assert workspace.Workspace(spark, tmp_dir).records().count() == 10
    first = workspace.Workspace(spark, tmp_dir).records_path()
    assert workspace.Workspace(spark, tmp_dir).records_path() == first
    events.limit(5).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    spark.catalog.refreshByPath(f"{tmp_dir}/events.parquet")
    assert workspace.Workspace(spark, tmp_dir).records().count() == 15
    assert workspace.Workspace(spark, tmp_dir).records_path() != first


def test_scratch_is_owned_and_removed(spark):
    kept = session._OWNED.pop(session.app_id(spark), [])
    path = session.scratch_path(spark, "mine").removeprefix("file:")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    assert session.release_scratch(spark) == 1 and not os.path.exists(path)
    assert session.release_scratch(spark) == 0
    session._OWNED[session.app_id(spark)] = kept


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Cluster:
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(_Cluster())


def test_deletion_errors_are_logged(spark, caplog):
    with caplog.at_level("WARNING"):
        session.delete_path(spark, "nosuchscheme://x/y")
    assert "could not remove" in caplog.text


def test_views_are_dropped(spark):
    from warbler.plans import workloads

    spark.range(1).createOrReplaceTempView("tweetTable")
    df = spark.createDataFrame([("a", "iranians", "b"), ("a", "IranElections", "c")],
                               "username string, hashtag string, mention string")
    before = {t.name for t in spark.catalog.listTables()}
    assert workloads.users_in_two_topics_sql(spark, df).count() == 1
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.table("tweetTable").select(F.col("id")).count() == 1
