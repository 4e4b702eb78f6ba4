"""Outputs that appear whole, and copies that later applications find."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from helpers import ROOT, record, write_text
from warbler.operators import topics
from warbler.plans import workloads, workspace
from warbler.sources import publish, records, sinks, tables


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("write, read", [
    (sinks.write_parquet, lambda s, p: s.read.parquet(p)),
    (sinks.write_csv, lambda s, p: s.read.schema("src string, dst string, weight double").csv(p)),
    (sinks.write_edge_list, tables.scan_edge_list),
])
def test_a_failed_overwrite_leaves_the_old_output(spark, tmp_dir, write, read):
    path = f"{tmp_dir}/out"
    old = spark.createDataFrame([("a", "b", 1.0)], "src string, dst string, weight double")
    assert write(old, path) == path
    bad = (spark.range(0, 100, 1, 4).select(F.col("id").cast("string").alias("src"), F.lit("x").alias("dst"),
           F.when(F.col("id") == 99, F.raise_error(F.lit("task fails")).cast("double")).otherwise(2.0).alias("weight")))
    with pytest.raises(Exception, match="task fails"):
        write(bad, path)
    assert _rows(read(spark, path)) == [("a", "b", 1.0)]
    assert os.listdir(tmp_dir) == ["out"]
    write(bad.filter("cast(src as int) < 50"), path)
    assert read(spark, path).count() > 5 and os.listdir(tmp_dir) == ["out"]
    write(read(spark, path).filter("src = '1'"), path)  # a table may replace itself
    assert _rows(read(spark, path)) == [("1", "x", 2.0)]


def test_parsed_once_per_version_of_the_records(spark, tmp_dir, monkeypatch):
    built = []
    real = workspace.tweet_table
    monkeypatch.setattr(workspace, "tweet_table", lambda df: built.append(1) or real(df))
    source = f"{tmp_dir}/records"
    os.mkdir(source)
    write_text(f"{source}/a", record("bob", "hi @amy #H1N1 x") + "\n\n")
    first = workspace.tweet_copy(spark, source)
    assert workspace.tweet_copy(spark, source) == first and built == [1]
    assert _rows(tables.read_tweet_table(spark, first)) == [("bob", "H1N1", "amy")]
    write_text(f"{source}/b", record("eve", "hi @amy #H1N1 x") + "\n\n")
    second = workspace.tweet_copy(spark, source)
    assert second != first and built == [1, 1]
    assert tables.read_tweet_table(spark, second).count() == 2
    assert {("tweet-table", p.rpartition("/")[2]) for p in (first, second)} <= {m[:2] for m in publish.manifest(spark)}


def test_a_failed_build_is_not_published(spark):
    def build(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        publish.published(spark, "half", "key", build)
    assert "half" not in {m[0] for m in publish.manifest(spark)}
    done = publish.published(spark, "half", "key", spark.range(3).write.parquet)
    other = publish.published(spark, "half", "key", lambda path: pytest.fail("it is there"))
    assert other == done and publish.withdraw(spark, "half") == 1
    assert "half" not in {m[0] for m in publish.manifest(spark)}


_JOB = """
import sys
from pyspark.sql import SparkSession
from warbler import __main__ as job
from warbler.plans import workspace
from warbler.session import local_session
spark = local_session(2, 2)
real = workspace.tweet_table
workspace.tweet_table = lambda df: print("PARSED") or real(df)
job.main(["topics", sys.argv[1], sys.argv[2]], spark)
"""


def test_a_second_application_does_not_parse_again(tmp_dir):
    source = write_text(f"{tmp_dir}/records", record("bob", "hi @amy and @eve #H1N1 x") + "\n\n")
    said = []
    for out in ("one", "two"):
        shared = f"--conf spark.checkpoint.dir=file://{tmp_dir}/shared pyspark-shell"
        run = subprocess.run([sys.executable, "-c", _JOB, source, f"{tmp_dir}/{out}"], cwd=ROOT, capture_output=True,
                             text=True, timeout=300, env=os.environ | {"PYSPARK_SUBMIT_ARGS": shared})
        assert run.returncode == 0, run.stderr[-2000:]
        said.append("PARSED" in run.stdout)
    assert said == [True, False]


def test_topic_report(spark, tmp_dir):
    rows = [("a", "Youtube", "x"), ("a", "IranElections", "x"), ("a", "iranians", None), ("b", "iranians", "y"),
            (None, "IranElections", "x"), (None, "iranians", "x"), ("c", "H1N1", "x"), ("d", "H1N1", "x")]
    tweets = spark.createDataFrame(rows, tables.TWEET_SCHEMA)
    out = workloads.topic_report(tweets, f"{tmp_dir}/report")
    read = lambda name: _rows(spark.read.parquet(f"{out}/{name}"))
    assert read("users") == [("a",)] and read("users-in-both") == [(1, "a", 0)]
    assert read("mention-users") == [("x", "c,d")] and read("rows-per-mention") == [("x", 2)]
    assert [r.value for r in spark.read.text(f"{out}/mention-users-csv").collect()] == ['x,"c,d"']


def test_one_scan_gives_the_rows_of_the_join(spark, tmp_dir):
    rows = [(u, t, m) for u in ("a", "b", None, "c") for t in ("IranElections", "iranians", "x") for m in ("m", None, "n")]
    rows = [r for i, r in enumerate(rows * 2) if i % 5]
    path = sinks.write_tweet_table(spark.createDataFrame(rows, tables.TWEET_SCHEMA), f"{tmp_dir}/tweets")
    tweets = tables.read_tweet_table(spark, path)
    one, joined = workloads.users_in_two_topics(tweets), workloads.users_in_two_topics_joined(tweets)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.columns == joined.columns and _rows(one) == _rows(joined) and len(_rows(one)) == 3
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange") == 1
    assert "In(hashtag, [IranElections,iranians])" in plan


def _row_groups_read(df):
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if "AdaptiveSparkPlan" in node.nodeName():
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


def test_bloom_filters_skip_what_ranges_do_not(spark, tmp_dir):
    """Each task's rows span all names, so no range of a row group excludes one; a name that two of the
    eight files hold is read from those."""
    n = 40_000
    names = F.concat(F.lit("m"), F.sha2(F.col("id").cast("string"), 256))
    rows = spark.range(0, n, 1, 8).select(F.lit("u").alias("username"), F.lit("t").alias("hashtag"), names.alias("mention"))
    path = sinks.write_tweet_table(rows, f"{tmp_dir}/tweets")
    plain = f"{tmp_dir}/plain"
    rows.write.option("parquet.enable.dictionary", "false").parquet(plain)
    wanted = rows.filter("mention like 'm8%'").first().mention
    assert wanted
    read = _row_groups_read(tables.read_tweet_table(spark, path).filter(F.col("mention") == wanted))
    all_read = _row_groups_read(spark.read.parquet(plain).filter(F.col("mention") == wanted))
    assert all_read == n and 0 < read <= n // 4
    assert topics.topic_users(tables.read_tweet_table(spark, path), "absent").count() == 0
    assert records.RECORD_SEPARATOR == "\n\n"
