import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from warbler.llm import suffix


def brute(rows, length=50):
    first = {}
    for i, text in rows:
        b = (text or "").encode()
        for p in range(len(b) - length + 1):
            w, key = b[p:p + length], suffix.NONE if i is None else i
            first[w] = min(first.get(w, key), key)
    out = []
    for i, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < (suffix.NONE if i is None else i):
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), len(suffix.runs(gone)[0]),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["the", "cat", "é", "run", "over", "xx", "日本"]

    def said(n):
        return " ".join(rng.choices(words, k=n))

    pool = [said(30) for _ in range(4)]
    out = [(i, "".join(rng.choice([said(rng.randint(0, 40)), rng.choice(pool), "a" * rng.randint(0, 130), " "])
                       for _ in range(rng.randint(0, 6)))) for i in range(60)]
    return out + [(60, None), (61, ""), (None, pool[0]), (None, pool[0]), (5, pool[1]), (5, out[5][1]),
                  (62, out[3][1]), (63, pool[0] * 9)]


@pytest.mark.parametrize("sizes", [
    {}, {"block_bytes": 300, "piece_bytes": 100},
    {"block_bytes": 300, "piece_bytes": 100, "fan_in": 3, "bucket_bytes": 3000, "bucket_prints": 100}])
def test_against_all_windows(spark, rows, sizes):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                               "doc_id long, text string, lo int, data string").repartition(3)
    kept = suffix.kept_texts(df, suffix.removed(df, **sizes))
    got = kept.select("doc_id", "_n_bytes", "_n_removed", "_n_spans", F.sha2("_bytes", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert kept.columns[:4] == df.columns


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.kept_texts(df, suffix.removed(df)).count() == 0


def test_rows_of_one_id_get_their_own_cuts_only(spark):
    """Rows without an id that each hold a passage of a smaller one, and one of them 40 times."""
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdefgh", k=80))
    rows = [(1, passage)] + [(None, f"{i:03d} {passage} {i}") for i in range(60)]
    rows += [(None, f"000 {passage} 0")] * 39 + [(7, f"x{passage}"), (7, f"y {passage}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # Small blocks: every copy of a repeated row is decided apart, and cut apart.
    cuts = suffix.removed(df, block_bytes=300, piece_bytes=100)
    lists = {r.text: r.cuts for r in suffix.with_cuts(df, cuts).select(
        "text", F.expr("transform(coalesce(_cuts, array()), c -> concat(c.lo, '-', c.hi))").alias("cuts")).collect()}
    assert not lists[passage]
    for text, own in lists.items():
        assert len(own) == len(set(own))
        assert len(own) <= len(text) and all(int(c.split("-")[1]) <= len(text) for c in own)
    plan = suffix.with_cuts(df, cuts)._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join LeftOuter" in line)
    assert "xxhash64" in join and "_mark" in join  # not by the id alone
    got = suffix.kept_texts(df, cuts).select("doc_id", "_n_bytes", "_n_removed", "_n_spans", F.sha2("_bytes", 256))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(3)
    for n in (1, 2, 9, 200, 1500):
        for alphabet in (1, 2, 200):
            text = rng.integers(0, alphabet, n).astype(np.uint8)
            if n > 100:
                text[n // 2:n // 2 + 60] = text[:60]
            padded = np.concatenate([text, np.zeros(58, np.uint8)])
            sa = suffix.suffix_array(padded, n, 50)
            raw = padded.tobytes()
            cut = [raw[i:i + 50] for i in range(n)]
            # Past the text's end a string is shorter, and comes first.
            want = sorted(range(n), key=lambda i: (text[i:i + 50].tobytes(), i))
            inner = [i for i in range(n) if i + 50 <= n]
            assert [i for i in sa.tolist() if i + 50 <= n] == [i for i in want if i + 50 <= n]
            shared = suffix.common_prefixes(padded, sa, 50)
            for at in range(1, n):
                if sa[at] in inner and sa[at - 1] in inner:
                    a, b = cut[sa[at]], cut[sa[at - 1]]
                    assert shared[at] == next((k for k in range(50) if a[k] != b[k]), 50)


def test_equal_windows_have_equal_fingerprints():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 256, 400).astype(np.uint8)
    b = np.concatenate([rng.integers(0, 256, 77).astype(np.uint8), a[100:300]])
    assert (suffix.fingerprints(a, 50)[100:251] == suffix.fingerprints(b, 50)[77:228]).all()


def test_a_hash_met_by_different_windows():
    data = np.frombuffer(b"x" * 50 + b"y" * 50 + b"x" * 50, np.uint8)
    got = suffix._least_ids(data, np.array([7, 7, 7], np.uint64), np.array([0, 50, 100]),
                            np.array([5, 3, 4]), np.array([0, 1, 2]), 50)
    assert got.tolist() == [4, 3, 4]
