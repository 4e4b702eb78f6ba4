"""Topic questions over the tweet table (username, hashtag, mention).

All are declarative so Catalyst pushes the hashtag filter into the Parquet scan and prunes to the
two columns each question reads; aggregates run partial (map side) then final.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic_users(tweets: DataFrame, topic: str) -> DataFrame:
    """Distinct users who used ``#topic`` (DataFrame form)."""
    return tweets.filter(F.col("hashtag") == topic).select("username").distinct()


def topic_users_sql(spark: SparkSession, view: str, topic: str) -> DataFrame:
    """Same question in SQL; ``LIKE`` without wildcards is case-sensitive equality."""
    return spark.sql(f"SELECT DISTINCT username FROM {view} WHERE hashtag LIKE :topic",
                     args={"topic": topic})


def topic_mention_counts(tweets: DataFrame, topic: str, alias: str) -> DataFrame:
    """(username, <alias>) = number of mention rows per user for ``#topic``."""
    return (tweets.filter(F.col("hashtag") == topic)
            .groupBy("username").agg(F.count("mention").alias(alias)))


def topic_mention_counts_sql(spark: SparkSession, view: str, topic: str, alias: str) -> DataFrame:
    return spark.sql(
        f"SELECT username, count(mention) AS {alias} FROM {view} "
        f"WHERE hashtag LIKE :topic GROUP BY username", args={"topic": topic})


def users_in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of two per-user aggregates on ``username``, dropping the left key: columns are
    left counts, username, right counts. Both sides hold one row per user, so no key is hot."""
    return left.join(right, left["username"] == right["username"], "inner").drop(left["username"])


def users_in_both_one_scan(tweets: DataFrame, first: tuple[str, str], second: tuple[str, str]) -> DataFrame:
    """The rows of ``users_in_both`` over the mention counts of two (topic, column name): one scan
    for both topics, one aggregation, and no join; a user is in both who has rows of both. (As in an
    inner join on the name, rows without a user match nothing.)"""
    of = [F.col("hashtag") == topic for topic, _ in (first, second)]
    return (tweets.filter(F.col("hashtag").isin(first[0], second[0]) & F.col("username").isNotNull())
            .groupBy("username")
            .agg(*[F.count(F.when(is_topic, F.col("mention"))).alias(alias)
                   for is_topic, (_, alias) in zip(of, (first, second))],
                 *[F.count_if(is_topic).alias(f"rows_{i}") for i, is_topic in enumerate(of)])
            .filter((F.col("rows_0") > 0) & (F.col("rows_1") > 0))
            .select(first[1], "username", second[1]))


def users_in_both_sql(spark: SparkSession, left_view: str, right_view: str, left_count: str,
                      right_count: str) -> DataFrame:
    return spark.sql(
        f"SELECT r.username, l.{left_count}, r.{right_count} "
        f"FROM {left_view} l INNER JOIN {right_view} r ON l.username = r.username")


def mention_user_count(tweets: DataFrame, topics: Sequence[str] = ("H1N1", "Oklahama"),
                       alias: str = "userCount") -> DataFrame:
    """(mention, userCount) = rows per mentioned user for any of ``topics``."""
    return (tweets.filter(F.col("hashtag").isin(*topics))
            .groupBy("mention").agg(F.count("username").alias(alias)))


def distinct_then_drop(tweets: DataFrame, topic: str) -> DataFrame:
    """Distinct (username, mention) of one topic: filter, distinct rows, drop the constant tag."""
    return tweets.filter(F.col("hashtag") == topic).distinct().drop("hashtag")


def mention_user_slices(tweets: DataFrame, topic: str = "H1N1",
                        partitions: int | None = None) -> DataFrame:
    """(mention, slice, usernames): the distinct users who mentioned each name under ``#topic``,
    sorted and comma-joined, in one or more slices; slice by slice they are the name's whole list.

    A mentioned name may hold a third of all rows, so its users are never gathered in one task:
    pairs are de-duplicated map side and range-partitioned on (mention, username), so a hot name
    spans many partitions in username order, and each partition joins its sorted slice.
    """
    pairs = tweets.filter(F.col("hashtag") == topic).select("mention", "username").distinct()
    by = ("mention", "username")
    dealt = pairs.repartitionByRange(partitions, *by) if partitions else pairs.repartitionByRange(*by)
    return (dealt.withColumn("slice", F.spark_partition_id()).groupBy("mention", "slice")
            .agg(F.array_join(F.array_sort(F.collect_list("username")), ",").alias("usernames")))


def mention_user_list(tweets: DataFrame, topic: str = "H1N1") -> DataFrame:
    """(mention, usernames): each name's whole list in one string, as the original has it. This view
    over ``mention_user_slices`` gathers a name's slices in one row; a list beyond what one value may
    hold (2 GB) fails the job, and nothing is cut. Use the slices where names may be that common."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("slice", "usernames"))),
                          lambda s: s["usernames"])
    return (mention_user_slices(tweets, topic).groupBy("mention")
            .agg(F.array_join(ordered, ",").alias("usernames")))
