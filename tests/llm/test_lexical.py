import math
import random
import re
import string

import numpy as np
import pytest

from compare import compare, duck
from warbler.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, words(t)) for i, t in docs]
    n_docs, total = sum(bool(b) for _, b in bags), sum(len(b) for _, b in bags)
    out = []
    for item in sorted({i for i, _ in items}):
        asked = {w for i, t in items if i == item for w in words(t)}
        weights = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                   for w in asked if (df := sum(w in b for _, b in bags))}
        found = []
        for doc_id, bag in bags:
            score = 0
            for w, x in weights.items():
                if tf := bag.count(w):
                    m = 100 - 90 + (90 * len(bag) * n_docs) // total
                    score += x * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        found.sort(key=lambda r: r[:3])
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return out


def test_terms():
    rng = random.Random(4)
    for size in (1, 3, 7):
        lexical.PIECE, was = size, lexical.PIECE
        try:
            for _ in range(300):
                text = "".join(rng.choices("aB9 .é漢_-\n", k=rng.randint(0, 40)))
                got = [w.decode() for part in lexical.terms(text.encode()) for w in part]
                assert got == words(text)
        finally:
            lexical.PIECE = was


VOCABULARY = [f"w{i}" for i in range(60)] + ["É", "straße", "a1"]


def corpus(seed, n, longest=60):
    rng = random.Random(seed)
    pick = [1 / (1 + i) for i in range(len(VOCABULARY))]
    rows = [(i, " ".join(rng.choices(VOCABULARY, pick, k=rng.randint(0, longest)))) for i in range(n)]
    return rows + [(5, rows[7][1]), (5, rows[7][1]), (None, rows[7][1]), (n, None), (n + 1, "... !"),
                   (n + 2, "W3 w3-w3 " * 3000), (n + 3, "")]


@pytest.mark.parametrize("shard, block_terms, parts", [(20_000, 500_000, 1), (17, 12, 5), (1, 1, 3)])
def test_search_is_brute_force(spark, shard, block_terms, parts):
    docs = corpus(1, 150)
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices(VOCABULARY + ["absent"], k=rng.randint(1, 9)))) for i in range(6)]
    items += [(3, "W1 w2"), (3, "W1 w2"), (9, None), (10, "???"), (11, "absent"), (12, "é É")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, score string, item int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = lexical.search(frame.repartition(parts), asked, shard=shard, block_terms=block_terms)
    assert sorted(map(tuple, got.collect())) == brute(docs, items)


def test_accumulators_are_limited():
    """Documents that hold only frequent terms get no accumulator, and no result changes."""
    docs = 4000
    rng = np.random.default_rng(5)
    rare = np.arange(0, docs, 80)
    term = np.concatenate([[0] * len(rare), *[[t] * docs for t in range(1, 6)]])
    doc = np.concatenate([rare, *[np.arange(docs)] * 5])
    order = np.argsort(doc, kind="stable")
    tf = np.where(term == 0, 5, rng.integers(1, 3, len(term)))
    n = np.full(docs, 50)
    part = lexical.Shard(np.bincount(doc), term[order], tf[order], n, docs, 50 * docs)
    query = [(0, 4000)] + [(t, 20) for t in range(1, 6)]
    counted = {}
    found, scores = part.best(query, 10, 0, counted)
    assert counted == {"updated": 6, "limited": 5} and found.tolist() == rare.tolist()
    assert not part.scores.any()
    want = {}
    for d, t, f in zip(doc[order].tolist(), term[order].tolist(), tf[order].tolist()):
        want[d] = want.get(d, 0) + dict(query)[t] * int(lexical.saturation(
            np.array([f]), np.array([50]), docs, 50 * docs)[0])
    top = sorted(want.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert sorted(zip(found.tolist(), scores.tolist()), key=lambda x: (-x[1], x[0]))[:10] == top
    # A score that others reach already ends the shard before its first term.
    assert not len(part.best(query, 10, 10 ** 12)[0])


def test_large_numbers():
    n = np.array([10 ** 9, 3])
    got = lexical.saturation(np.array([2, 2]), n, 10 ** 10, 10 ** 15)
    m = [10 + 90 * x * 10 ** 10 // 10 ** 15 for x in (10 ** 9, 3)]
    assert got.tolist() == [2 * 10 ** 9 // (2000 + 8 * x) for x in m]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(none, one).count() == 0
    assert lexical.search(one.withColumnRenamed("item_id", "doc_id"), one.limit(0)).count() == 0


def test_query(spark):
    got = lexical.op11_lexical_search(spark, "/root/testdata/sf0.001")
    assert [f"{n} {t}" for n, t in got.dtypes] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    ok, message = compare(got, duck("/root/testdata/sf0.001"), lexical.OP11_SQL)
    assert ok, message
