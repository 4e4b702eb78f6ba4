"""User lists as files: round trips by name and by place."""

import pytest
from pyspark.sql import functions as F

from warbler.operators import topics
from warbler.sources import lists


@pytest.fixture(scope="module")
def tweets(spark):
    rows = [(f"user{i * 7919 % 4000:05d}", "t", "hot" if i % 3 else f"m{i % 7}") for i in range(4000)]
    rows += [("é", "t", "m1"), ("x", "t", "漢"), ("last", "t", "m1")]
    return spark.createDataFrame(rows, "username string, hashtag string, mention string")


@pytest.fixture(scope="module")
def written(spark, tweets, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lists") / "out")
    return lists.write_user_lists(topics.mention_user_slices(tweets, "t", partitions=9), path, partitions=5)


def test_lists_by_name(spark, tweets, written):
    want = {r.mention: r.usernames for r in topics.mention_user_list(tweets, "t").collect()}
    sizes = {r.mention: (r.slices, r.list_bytes) for r in lists.list_sizes(spark, written).collect()}
    assert {k: n for k, (_, n) in sizes.items()} == {k: len(v.encode()) for k, v in want.items()}
    assert sizes["hot"][0] > 3
    for name in ("hot", "m1", "漢"):
        rows = lists.read_user_list(spark, written, name).orderBy("list_offset").collect()
        assert ",".join(r.usernames for r in rows) == want[name]
        at = 0
        for r in rows:
            assert r.list_offset == at
            at += len(r.usernames.encode()) + 1
        whole = b"".join(lists.stream_user_list(spark, written, name, chunk=1000))
        assert whole == want[name].encode()
        for start, length in ((0, 10), (37, 500), (max(0, len(whole) - 5), 100), (3, 0)):
            got = b"".join(lists.stream_user_list(spark, written, name, start, length, chunk=64))
            assert got == whole[start:start + length], (name, start, length)
    assert lists.read_user_list(spark, written, "absent").count() == 0
    assert list(lists.stream_user_list(spark, written, "absent")) == []


def test_pieces_are_small_and_few_files_are_read(spark, written):
    assert max(map(len, lists.stream_user_list(spark, written, "hot", chunk=100))) <= 100
    files = lists.read_index(spark, written).select("file").distinct().count()
    own = lists.read_user_list(spark, written, "m1").select(F.col("list_offset"))
    assert len(own.inputFiles()) < files

