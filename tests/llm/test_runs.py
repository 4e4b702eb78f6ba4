import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from warbler.llm import runs


def brute_runs(x, least=6, times=4):
    """All (start, length, smallest period), by comparing every distance."""
    found, n = [], len(x)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(x[k] == x[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(least, times * q) and not smaller:
                found.append((i, length, q))
            i = j
    return sorted(found)


def brute_row(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(kept)))


def test_transform_multiplies():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 64):
        a, b = rng.integers(0, runs.PRIME, (2, 3, n))
        got = runs.ntt(runs.ntt(a) * runs.ntt(b) % runs.PRIME, inverse=True)
        for i in range(3):
            want = [sum(int(a[i, j]) * int(b[i, (k - j) % n]) for j in range(n)) % runs.PRIME
                    for k in range(n)]
            assert got[i].tolist() == want


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    x = []
    while len(x) < rng.choice([5, 40, 200]):
        piece = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(1, 12))]
        x += (piece * rng.randint(1, 7))[:rng.randint(1, 80)]
    if seed % 3 == 0:  # runs within a run
        x = x[:40] * 5
    assert runs.find_runs(np.array(x, np.int64)) == brute_runs(x)


def test_long_runs_in_little_work(monkeypatch):
    made = []
    real = runs._zero_mismatch
    monkeypatch.setattr(runs, "_zero_mismatch", lambda v, s, b: made.append(len(s) * b) or real(v, s, b))
    assert runs.find_runs(np.zeros(100_000, np.int64)) == [(0, 100_000, 1)]
    assert sum(made) < 500_000
    x = np.tile(np.arange(20_000), 5)
    assert runs.find_runs(x) == [(0, 100_000, 20_000)]
    assert runs.find_runs(np.arange(100_000)) == []
    # a run of runs: every period is the smallest of its own stretch
    inner = np.concatenate([np.tile([1, 2, 3], 5), [7, 8]])
    got = runs.find_runs(np.tile(inner, 6))
    assert (0, 17 * 6, 17) in got and got == brute_runs(np.tile(inner, 6).tolist())


def test_chance_zeros_make_no_run(monkeypatch):
    monkeypatch.setattr(runs, "_residues", lambda ids: ids % 2)
    x = np.arange(0, 400, 2)
    assert runs.find_runs(np.concatenate([x, x])) == []


TEXTS = [None, "", " \n ", "a", "a a a a a a", "a a a a a", "x a b a b a b a b y", "é é é é é é é",
         "a b " * 300, "w " * 5000 + "end", "a a a a a a b " * 8, "\x0ba\x0cb\x1cc a"]


def test_query(spark, tmp_dir):
    rng = random.Random(3)
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[6], "x"), (None, TEXTS[6], "y"), (3, TEXTS[6], "x")]
    rows += [(1000 + i, " ".join(rng.choices("abcdefgh", k=rng.randint(0, 120))), "z") for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = runs.op13_block_runs(spark, tmp_dir)
    assert [f"{n} {t}" for n, t in got.dtypes] == [
        "doc_id bigint", "n_runs bigint", "start bigint", "length bigint", "period bigint",
        "exponent_milli bigint", "runs_sha256 string", "collapsed_sha256 string"]
    want = [brute_row(r[0], r[1]) for r in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 12
    small = runs.document_runs(docs, change=runs.rewritten, batch_words=1).drop("runs").collect()
    assert sorted((r.key, r.n_runs) for r in small if r.key) == sorted((r[0], r[1]) for r in want if r[0])


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert runs.document_runs(docs).count() == 0
