"""Writers read back through the matching reader."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import write_text
from warbler.operators import quality
from warbler.sources import records, sinks, tables


def test_record_file_round_trip(spark, tmp_dir):
    vals = ["T\ta\nU\thttp://twitter.com/a\nW\tx #t @b", "total number:2\nT\tb\nU\tu\nW\ty"]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    path = records.write_records(df, f"{tmp_dir}/recs")
    back = [r.value for r in records.scan_records(spark, path).collect()]
    assert sorted(back) == sorted(vals)


def test_tweet_table_parquet_round_trip_and_pushdown(spark, tmp_dir):
    df = spark.createDataFrame([("a", "t1", "m"), ("b", "t2", "n")], tables.TWEET_SCHEMA)
    path = sinks.write_tweet_table(df, f"{tmp_dir}/tweets")
    back = tables.read_tweet_table(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "t1", "m"), ("b", "t2", "n")]
    plan = back.filter(F.col("hashtag") == "t1").select("username")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "EqualTo(hashtag,t1)" in plan
    assert "ReadSchema: struct<username:string,hashtag:string>" in plan


def test_csv_single_file_keeps_commas(spark, tmp_dir):
    df = spark.createDataFrame([("m", "a,b,c")], "mention string, usernames string")
    path = sinks.write_csv(df, f"{tmp_dir}/csv", single_file=True)
    back = spark.read.schema("mention string, usernames string").csv(path).collect()
    assert [tuple(r) for r in back] == [("m", "a,b,c")]


def test_text_pairs_and_existing_path(spark, tmp_dir):
    df = spark.createDataFrame([("x No Post Title",), ("W\tNo Post Title",), ("W\tok",)],
                               "value string")
    path = sinks.write_text_pairs(quality.record_type_counts(df), f"{tmp_dir}/pairs")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["(bad,1)", "(good,2)"]
    with pytest.raises(AnalysisException):
        sinks.write_text_pairs(quality.record_type_counts(df), path)


def test_edge_list_round_trip(spark, tmp_dir):
    edges = spark.createDataFrame([("a", "b", 2), ("a", "c", 1)], "src string, dst string, weight long")
    path = sinks.write_edge_list(edges, f"{tmp_dir}/edges")
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["a,b,2", "a,c,1"]
    back = tables.scan_edge_list(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", "b", 2.0), ("a", "c", 1.0)]


def test_edge_list_quoted_field_and_bad_weight(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/q.csv", '"x ""q"", y",b,1.5\n')
    assert [tuple(r) for r in tables.scan_edge_list(spark, p).collect()] == [('x "q", y', "b", 1.5)]
    bad = write_text(f"{tmp_dir}/bad.csv", "a,b,heavy\n")
    with pytest.raises(Exception):
        tables.scan_edge_list(spark, bad).collect()


def test_edge_list_empty_name_is_a_node(spark, tmp_dir):
    p = write_text(f"{tmp_dir}/empty.csv", ",b,1\n")
    assert [tuple(r) for r in tables.scan_edge_list(spark, p).collect()] == [("", "b", 1.0)]
