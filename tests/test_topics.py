"""Topic questions: DataFrame form = SQL form, and the skew-safe user lists."""

import pytest
from pyspark.sql import functions as F

from warbler.operators import topics
from warbler.plans import workloads as W
from warbler.plans.workspace import Workspace
from helpers import SF_SMALL


@pytest.fixture(scope="module")
def tweet_df(spark):
    return Workspace(spark, SF_SMALL).tweets()


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_users_df_equals_sql(spark, tweet_df):
    tweet_df.createOrReplaceTempView("tweetTable")
    a = topics.topic_users(tweet_df, "Youtube")
    b = topics.topic_users_sql(spark, "tweetTable", "Youtube")
    assert _set(a) == _set(b) and len(_set(a)) == 16


def test_like_without_wildcard_is_case_sensitive(spark, tweet_df):
    tweet_df.createOrReplaceTempView("tweetTable")
    assert topics.topic_users_sql(spark, "tweetTable", "youtube").count() == 0


def test_join_df_equals_sql(spark, tweet_df):
    a = W.users_in_two_topics(tweet_df)
    assert a.columns == ["iranElectionsMentionNumber", "username", "iraniansMentionNumber"]
    b = W.users_in_two_topics_sql(spark, tweet_df)
    assert b.columns == ["username", "iranElectionsMentionNumber", "iraniansMentionNumber"]
    assert _set(a.select(*b.columns)) == _set(b)
    assert b.count() == 16


def test_mention_user_count_counts_rows(spark):
    df = spark.createDataFrame(
        [("a", "H1N1", "m"), ("a", "H1N1", "m"), ("b", "Oklahama", "m"), ("c", "x", "m")],
        "username string, hashtag string, mention string")
    assert _set(topics.mention_user_count(df)) == [("m", 3)]


def test_mention_user_list_sorted_distinct(spark):
    rows = [("u%03d" % (i % 37), "H1N1", "hot") for i in range(500)]
    rows += [("b", "H1N1", "cold"), ("a", "H1N1", "cold"), ("a", "H1N1", "cold"), ("z", "x", "cold")]
    df = spark.createDataFrame(rows, "username string, hashtag string, mention string")
    got = dict(topics.mention_user_list(df).collect())
    assert got["cold"] == "a,b"
    assert got["hot"] == ",".join(sorted({"u%03d" % (i % 37) for i in range(500)}))


def test_mention_user_list_hot_name_spans_partitions(spark):
    # One mentioned name holds almost all rows: its users are range-split over many
    # partitions and the sorted slices are joined in order.
    n = 5000
    df = (spark.range(n).select(F.format_string("user%05d", (F.col("id") * 7919) % n).alias("username"),
                                F.lit("H1N1").alias("hashtag"), F.lit("hot").alias("mention"))
          .union(spark.createDataFrame([("x", "H1N1", "cold")], "username string, hashtag string, mention string")))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lists = topics.mention_user_list(df)
        slices = (df.filter("hashtag = 'H1N1'").select("mention", "username").distinct()
                  .repartitionByRange("mention", "username")
                  .withColumn("p", F.spark_partition_id())
                  .filter("mention = 'hot'").select("p").distinct().count())
        got = dict(lists.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert slices > 1
    assert got["hot"] == ",".join("user%05d" % i for i in range(n))
    assert got["cold"] == "x"


def test_distinct_then_drop(spark):
    df = spark.createDataFrame(
        [("a", "H1N1", "m"), ("a", "H1N1", "m"), ("a", "other", "k")],
        "username string, hashtag string, mention string")
    out = topics.distinct_then_drop(df, "H1N1")
    assert out.columns == ["username", "mention"] and _set(out) == [("a", "m")]


def test_mention_user_list_with_coalesced_ranges(spark):
    # AQE may merge adjacent range partitions; slices stay contiguous and ordered.
    n = 3000
    df = spark.range(n).select(
        F.format_string("p%04d", (F.col("id") * 13) % n).alias("username"),
        F.lit("H1N1").alias("hashtag"),
        F.when(F.col("id") % 3 == 0, F.lit("m1")).otherwise(F.lit("m2")).alias("mention"))
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        got = dict(topics.mention_user_list(df).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    want = {}
    for i in range(n):
        want.setdefault("m1" if i % 3 == 0 else "m2", set()).add("p%04d" % ((i * 13) % n))
    assert got == {k: ",".join(sorted(v)) for k, v in want.items()}
