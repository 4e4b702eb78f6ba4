"""Times the headline workloads on one data directory; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_SHUFFLE_PARTITIONS
(default: BENCH_CPUS). Each step is forced with a full write (or Spark's ``noop`` sink), never by
collecting rows to the driver.

Before the timed pass, the same steps run once untimed on the smallest sibling data directory
(``sf0.001`` next to BENCH_SF_DIR, when present) so that the JVM has compiled the operators, as
it has on a long-running cluster; that time is reported as ``warmup_sec``, outside ``value``.
Set BENCH_WARMUP=0 to skip it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from warbler.operators import graph, topics, tweets  # noqa: E402
from warbler.plans import workloads as W  # noqa: E402
from warbler.session import env_int, local_session, release_scratch, scratch_path  # noqa: E402
from warbler.sources import records as rec  # noqa: E402
from warbler.sources import sinks, tables  # noqa: E402
from warbler.sources.events import records_from_events  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def run_steps(spark, data_dir: str) -> dict[str, float]:
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    events = spark.read.parquet(os.path.join(data_dir, "events.parquet"))
    raw = timed("derive_records", lambda: rec.write_records(records_from_events(events),
                                                            scratch_path(spark, "bench-records")))
    records = rec.scan_records(spark, raw)
    tweet_path = timed("w1_tweet_table", lambda: W.build_tweet_table(
        spark, raw, scratch_path(spark, "bench-tweets")))
    tw = tables.read_tweet_table(spark, tweet_path)
    timed("row_counts", lambda: _force(tweets.row_counts(records)))
    timed("w2_topic_users_df", lambda: _force(W.users_of_topic(tw, "Youtube")))
    with W.views(spark, tw) as (view,):
        timed("w2_topic_users_sql", lambda: _force(topics.topic_users_sql(spark, view, "Youtube")))
    timed("w3_topic_mentions", lambda: (_force(W.mentions_per_user(tw, *W.IRAN_ELECTIONS)),
                                        _force(W.mentions_per_user(tw, *W.IRANIANS))))
    timed("w4_topic_join_df", lambda: _force(W.users_in_two_topics(tw)))
    timed("w4_topic_join_sql", lambda: _force(W.users_in_two_topics_sql(spark, tw)))
    timed("w5_mention_user_count", lambda: _force(W.rows_per_mention(tw)))
    timed("w6_mention_user_list", lambda: W.save_mention_users(
        W.mention_users(tw, "H1N1"), scratch_path(spark, "bench-lists-parquet"),
        scratch_path(spark, "bench-lists-csv")))
    timed("w7_bad_record_report", lambda: W.bad_record_report(
        records, scratch_path(spark, "bench-report")))
    timed("mention_edges", lambda: sinks.write_edge_list(
        graph.mention_edges(records), scratch_path(spark, "bench-mention-edges")))
    timed("w9_topic_betweenness", lambda: _force(W.topic_centrality(
        spark, records, "H1N1", scratch_path(spark, "bench-topic-edges"))))
    return times


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = env_int("BENCH_CPUS", 8)
    spark = local_session(cpus, shuffle_partitions=env_int("BENCH_SHUFFLE_PARTITIONS", cpus),
                          app="warbler-bench",
                          driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
    warm_dir = os.path.join(os.path.dirname(os.path.normpath(data_dir)), "sf0.001")
    warmup = None
    if os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(warm_dir):
        t0 = time.perf_counter()
        run_steps(spark, warm_dir)
        warmup = round(time.perf_counter() - t0, 3)
    times = run_steps(spark, data_dir)
    sf = os.path.basename(os.path.normpath(data_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_workload_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "warmup_sec": warmup}))
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
