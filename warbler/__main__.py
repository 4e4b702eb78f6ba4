"""The programs as jobs: ``spark-submit`` or ``python -m warbler`` with one of

    tweet-table RECORDS OUT      record files to the tweet table in Parquet
    bad-records RECORDS OUT      (type,count) lines of good and bad records
    topics RECORDS OUT           the topic questions (W2 to W6) over the tweet table of record files,
                                 which is parsed once and found again by later jobs
    topics-of-table TABLE OUT    the same over a tweet table written before
    centrality EDGES OUT         src,dst,weight lines to betweenness and node sizes in Parquet

Paths are any Hadoop URIs. The session is the cluster's; its settings come from outside.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from warbler.plans import workloads
from warbler.plans.workspace import tweet_copy
from warbler.sources.records import scan_records
from warbler.sources.sinks import write_parquet
from warbler.sources.tables import read_tweet_table


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> str:
    """Runs one job and returns the path it wrote."""
    parser = argparse.ArgumentParser(prog="warbler")
    parser.add_argument("job", choices=["tweet-table", "bad-records", "topics",
                                        "topics-of-table", "centrality"])
    parser.add_argument("source")
    parser.add_argument("out")
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.appName(f"warbler {given.job}").getOrCreate()
    if given.job == "tweet-table":
        return workloads.build_tweet_table(spark, given.source, given.out)
    if given.job == "bad-records":
        return workloads.bad_record_report(scan_records(spark, given.source), given.out)
    if given.job.startswith("topics"):
        path = tweet_copy(spark, given.source) if given.job == "topics" else given.source
        return workloads.topic_report(read_tweet_table(spark, path), given.out)
    return write_parquet(workloads.edge_list_centrality(spark, given.source), given.out)


if __name__ == "__main__":
    main()
