"""The file-stream ingest gives the same tweet table as the batch job, and resumes."""

import os
import subprocess
import sys

import pytest

from helpers import ROOT, record, write_text
from warbler.operators import tweets
from warbler.sources.records import scan_records
from warbler.streaming import stream_tweet_table
from warbler.streaming.ingest import default_progress_location


def test_stream_matches_batch_and_resumes(spark, tmp_dir):
    src, out, ckpt = (os.path.join(tmp_dir, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    write_text(f"{src}/a.txt", "total number:3\n" + record("a", "x @b #t @c") + "\n\n"
               + record("b", "No Post Title") + "\n\n")
    q = stream_tweet_table(spark, src, out, ckpt)
    q.awaitTermination(120)
    first = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert first == [("a", "t", "b"), ("a", "t", "c")]
    write_text(f"{src}/b.txt", record("c", "y @d #u #v"))
    q = stream_tweet_table(spark, src, out, ckpt)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = sorted(tuple(r) for r in tweets.tweet_table(scan_records(spark, src)).collect())
    assert got == batch and len(got) == 4


STEP = """
import sys
from pyspark.sql import SparkSession
from warbler.streaming import stream_tweet_table
from warbler.streaming.ingest import default_progress_location
root, by_conf = sys.argv[1], sys.argv[2] == "conf"
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
if by_conf:
    b = b.config("spark.checkpoint.dir", root + "/shared")
spark = b.getOrCreate()
if not by_conf:
    spark.sparkContext.setCheckpointDir(root + "/shared")
where = None if by_conf else root + "/progress"
stream_tweet_table(spark, root + "/in", root + "/out", where).awaitTermination(120)
print("ROWS", sorted(map(tuple, spark.read.parquet(root + "/out").collect())))
"""


@pytest.mark.parametrize("way", ["conf", "context"])
def test_a_new_application_goes_on(tmp_dir, way):
    """Two applications, a file more for the second; the folder set by conf or on the context."""
    os.makedirs(f"{tmp_dir}/in")
    for number, user in enumerate(("a", "c")):
        write_text(f"{tmp_dir}/in/{number}.txt", record(user, "x @b #t"))
        done = subprocess.run([sys.executable, "-c", STEP, tmp_dir, way], cwd=ROOT, text=True,
                              capture_output=True, env={**os.environ, "PYTHONPATH": ROOT}, timeout=200)
        assert done.returncode == 0, done.stderr[-2000:]
    assert "ROWS [('a', 't', 'b'), ('c', 't', 'b')]" in done.stdout


class _NoFolder:
    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_no_default_without_a_shared_folder():
    with pytest.raises(ValueError, match="checkpoint_location"):
        default_progress_location(_NoFolder(), "/out")
