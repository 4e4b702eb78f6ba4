"""Typed tables: the tweet table in Parquet and edge lists in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

TWEET_SCHEMA = StructType([
    StructField("username", StringType(), True),
    StructField("hashtag", StringType(), True),
    StructField("mention", StringType(), True),
])

EDGE_LIST_SCHEMA = StructType([
    StructField("src", StringType(), True),
    StructField("dst", StringType(), True),
    StructField("weight", DoubleType(), True),
])


def read_tweet_table(spark: SparkSession, path: str) -> DataFrame:
    """The tweet table written by ``write_tweet_table`` (self-described Parquet)."""
    return spark.read.parquet(path)


def scan_edge_list(spark: SparkSession, path: str, keep_order: bool = False) -> DataFrame:
    """``src,dst,weight`` lines without a header; fields after the third are ignored. The weight is
    read as a double: one that is no number fails the job, a missing one stays NULL and is rejected by
    the graph. Fields may be quoted with doubled quotes inside.

    With ``keep_order`` a ``line_order`` struct (file, split start, row id) is added; ordering by
    it gives file order within each file, files by name, so "last line wins" is well defined.
    """
    df = (spark.read.schema("src string, dst string, weight string")
          .option("header", "false")
          .option("escape", '"')
          .option("mode", "PERMISSIVE")
          .csv(path))
    number = F.trim("weight").try_cast("double")
    wrong = F.raise_error(F.concat(F.lit("not a weight: "), F.col("weight")))
    weight = F.when(F.col("weight").isNotNull() & number.isNull(), wrong.cast("double")).otherwise(number)
    # An empty endpoint is the node named "" (as a plain CSV reader gives it), not a missing
    # value; an empty weight stays NULL and is rejected downstream.
    df = df.select(F.coalesce("src", F.lit("")).alias("src"),
                   F.coalesce("dst", F.lit("")).alias("dst"), weight.alias("weight"))
    if keep_order:
        df = df.withColumn("line_order", F.struct(
            F.input_file_name().alias("file"),
            F.input_file_block_start().alias("start"),
            F.monotonically_increasing_id().alias("row")))
    return df
