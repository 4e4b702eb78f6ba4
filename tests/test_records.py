"""Record scan and parsing: one test per semantic decision."""

from helpers import record, write_text
from pyspark.sql import functions as F

from warbler.functions import record as R
from warbler.operators import quality, tweets
from warbler.sources.records import scan_records


def _scan(spark, tmp_dir, text, name="in.txt"):
    return scan_records(spark, write_text(f"{tmp_dir}/{name}", text))


def _values(df, col="value"):
    return [r[col] for r in df.collect()]


def test_blank_line_separates_records(spark, tmp_dir):
    text = "total number:2\n" + record("a", "x") + "\n\n" + record("b", "y") + "\n\n"
    assert len(_values(_scan(spark, tmp_dir, text))) == 2


def test_file_endings_give_same_records(spark, tmp_dir):
    body = record("a", "x #t @b") + "\n\n" + record("b", "y")
    counts = [len(_values(_scan(spark, tmp_dir, body + tail, f"f{i}.txt")))
              for i, tail in enumerate(["", "\n", "\n\n"])]
    assert counts == [2, 2, 2]
    # three trailing newlines leave one extra record, "\n", which is malformed
    recs = _scan(spark, tmp_dir, body + "\n\n\n", "f3.txt")
    assert len(_values(recs)) == 3
    assert tweets.malformed_records(recs).count() == 1


def test_scan_is_split_safe(spark, tmp_dir):
    body = "\n\n".join(record(f"u{i}", f"m{i} #t @x") for i in range(400)) + "\n\n"
    path = write_text(f"{tmp_dir}/big.txt", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        df = scan_records(spark, path)
        assert df.rdd.getNumPartitions() > 10
        vals = _values(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(vals) == sorted(record(f"u{i}", f"m{i} #t @x") for i in range(400))


def test_three_newlines_still_parse(spark, tmp_dir):
    text = record("a", "one #t @b") + "\n\n\n" + record("c", "two #t @d")
    rows = tweets.tweet_table(_scan(spark, tmp_dir, text)).collect()
    assert sorted((r.username, r.hashtag, r.mention) for r in rows) == [
        ("a", "t", "b"), ("c", "t", "d")]


def test_four_newlines_make_a_malformed_record(spark, tmp_dir):
    text = record("a", "x") + "\n\n\n\n" + record("c", "y")
    recs = _scan(spark, tmp_dir, text)
    assert recs.count() == 3
    assert tweets.malformed_records(recs).count() == 1
    assert tweets.row_counts(recs).first().malformed_records == 1


def test_header_record_message_is_fourth_line(spark, tmp_dir):
    text = "total number:1\n" + record("a", "hello #x @y")
    df = _scan(spark, tmp_dir, text).select(R.message_text("value").alias("m"),
                                            R.is_header("value").alias("h"))
    assert df.first().asDict() == {"m": "W\thello #x @y", "h": True}


def test_user_pattern_and_placeholder(spark):
    vals = [record("bob"), record("ann", url="http://www.twitter.com/"),
            record("eve", url="http://example.com/"), "T\tx\nU\thttp://twitter.com/bob/\nW\tm"]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    assert _values(df.select(R.username("value").alias("u")), "u") == [
        "bob", "ann", "?????", "?????"]


def test_mentions_and_tags_scan_whole_record_in_order(spark):
    v = record("a", "x @b @c @b #t1 #t2 #t1")
    r = spark.createDataFrame([(v,)], "value string").select(
        R.mentions("value").alias("m"), R.hashtags("value").alias("h")).first()
    assert r.m == ["b", "c", "b"] and r.h == ["t1", "t2", "t1"]


def test_cross_product_keeps_duplicates(spark):
    v = record("a", "@b @c #x #x")
    rows = tweets.tweet_table(spark.createDataFrame([(v,)], "value string")).collect()
    assert len(rows) == 4
    assert sorted((r.mention, r.hashtag) for r in rows) == [
        ("b", "x"), ("b", "x"), ("c", "x"), ("c", "x")]


def test_signs_without_words_pass_filter_but_yield_nothing(spark):
    df = spark.createDataFrame([(record("a", "bare # and @ signs"),)], "value string")
    assert tweets.marked_records(df).count() == 1
    assert tweets.tweet_table(df).count() == 0


def test_prefilter_reads_only_message_line(spark):
    # the user line has no signs; a mention in the T line is extracted but not filtered on
    v = "T\t@z\nU\thttp://twitter.com/a\nW\tonly #t"
    df = spark.createDataFrame([(v,)], "value string")
    assert tweets.marked_records(df).count() == 0


def test_email_counts_as_mention(spark):
    df = spark.createDataFrame([(record("a", "mail x@host.com #t"),)], "value string")
    assert [r.mention for r in tweets.tweet_table(df).collect()] == ["host"]


def test_word_chars_are_ascii(spark):
    df = spark.createDataFrame([(record("a", "#café_é @x"),)], "value string")
    assert df.select(R.hashtags("value").alias("h")).first().h == ["caf"]


def test_has_hashtag_needs_a_following_character(spark):
    vals = ["… #H1N1", "x #H1N1é", "x #H1N12 ", "x #H1N1 y", "x #h1n1 y"]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    got = _values(df.select(R.has_hashtag("value", "H1N1").alias("b")), "b")
    assert got == [False, True, False, True, False]
    at_end = _values(df.select(R.has_hashtag("value", "H1N1", match_at_end=True).alias("b")), "b")
    assert at_end == [True, True, False, True, False]


def test_has_hashtag_tag_is_literal(spark):
    df = spark.createDataFrame([("x #a.b y",), ("x #axb y",)], "value string")
    assert _values(df.select(R.has_hashtag("value", "a.b").alias("b")), "b") == [True, False]


def test_bad_records_and_labels(spark):
    vals = [record("a", "No Post Title"), record("b", "No Post Title xyz"), record("c", "fine")]
    df = spark.createDataFrame([(v,) for v in vals], "value string")
    assert quality.bad_record_total(df).first().bad_records == 2
    got = {r.record_type: r["count"] for r in quality.record_type_counts(df).collect()}
    assert got == {"bad": 2, "good": 1}


def test_empty_input_counts_zero(spark, tmp_dir):
    recs = _scan(spark, tmp_dir, "")
    assert quality.bad_record_total(recs).first().bad_records == 0
    assert quality.record_type_counts(recs).count() == 0
    rc = tweets.row_counts(recs).first()
    assert (rc.records, rc.tweet_rows) == (0, 0)


def test_no_python_in_parse_plan(spark):
    df = spark.createDataFrame([(record("a", "@b #c"),)], "value string")
    plan = tweets.tweet_table(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
