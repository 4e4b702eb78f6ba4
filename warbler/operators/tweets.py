"""Record → tweet table (username, hashtag, mention).

The pre-filter looks only at the message line; extraction scans the whole record. Each kept
record yields the cross product mentions × hashtags with repeats kept; a record whose message has
both signs but no word after them yields no row (inner explode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warbler.functions import record as R
from warbler.sources.tables import TWEET_SCHEMA


def parse_tweets(records: DataFrame, value: str = "value") -> DataFrame:
    """``value`` → (value, username, mentions, hashtags), one row per record."""
    v = F.col(value)
    return records.select(
        v.alias("value"),
        R.username(v).alias("username"),
        R.mentions(v).alias("mentions"),
        R.hashtags(v).alias("hashtags"),
    )


def marked_records(records: DataFrame, value: str = "value") -> DataFrame:
    """Records whose message line has both ``#`` and ``@``."""
    return records.filter(R.is_marked(F.col(value)))


def tweet_table(records: DataFrame, value: str = "value") -> DataFrame:
    """The typed tweet table. Narrow only: filter, regex extraction and two generators."""
    v = F.col(value)
    parsed = marked_records(records, value).select(
        R.username(v).alias("username"),
        R.mentions(v).alias("mentions"),
        R.hashtags(v).alias("hashtags"),
    )
    rows = (parsed
            .select("username", F.explode("mentions").alias("mention"), "hashtags")
            .select("username", F.explode("hashtags").alias("hashtag"), "mention"))
    return rows.to(TWEET_SCHEMA)


def malformed_records(records: DataFrame, value: str = "value") -> DataFrame:
    """Records with too few lines for a message (the original job would crash on them)."""
    return records.filter(R.message_text(F.col(value)).isNull())


def row_counts(records: DataFrame, value: str = "value") -> DataFrame:
    """All record-level counts in one pass: records, bad, malformed, marked, tweet-table rows."""
    v = F.col(value)
    marked = R.is_marked(v)
    rows = F.when(marked, F.size(R.mentions(v)).cast("long") * F.size(R.hashtags(v))).otherwise(0)
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(R.is_bad(v)).alias("bad_records"),
        F.count_if(R.message_text(v).isNull()).alias("malformed_records"),
        F.count_if(marked).alias("marked_records"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("long").alias("tweet_rows"),
    )
