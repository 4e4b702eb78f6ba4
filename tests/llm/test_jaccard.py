import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from warbler.llm import jaccard, store


def sets(rows, words):
    out = []
    for _, text in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out.append({tuple(w[j:j + words]) for j in range(len(w) - words + 1)} if len(w) >= words
                   else {tuple(w)} if w else set())
    return out


def brute(rows, words, num, den):
    own, parent = sets(rows, words), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if own[a] and own[b] and den * len(own[a] & own[b]) >= num * len(own[a] | own[b]):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return sorted(((i, len(own[a]), least.get(root(a)) if own[a] else i)
                   for a, (i, _) in enumerate(rows)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 120]))
        for _ in range(rng.choice([1, 3, 12, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5]) if len(base) > 4 else 0):
                j = rng.randrange(len(w))
                w[j:j + rng.choice([0, 1])] = [rng.choice(vocabulary) + "x" * rng.randrange(3)]
            out.append((len(out) * 3 % 400, " ".join(w)))
    return out + [(None, None), (7, ""), (8, " \t "), (9, "One two"), (10, "one  TWO"), (11, "one two three"),
                  (None, out[3][1]), (None, "zz yy xx"), (None, "zz yy xx"), (3, out[9][1]), (3, out[9][1])]


@pytest.mark.parametrize("words, num", [(3, 90), (5, 80)])
def test_components_are_exact(spark, rows, words, num):
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows],
                               "doc_id long, text string, n int, class string").repartition(3)
    got = jaccard.components(df, words=words, num=num).collect()
    assert sorted(((r.id, r.n_shingles, r.component) for r in got), key=str) == brute(rows, words, num, 100)


def test_keep_one(spark, rows):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, mark int")
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    want = brute(rows, 5, 80, 100)
    empty = sum(n == 0 for _, n, _ in want)
    groups = {c for _, n, c in want if n and c is not None}
    nameless = {t for i, t in rows if i is None and t and (None, len(sets([(i, t)], 5)[0]), None) in want}
    got = kept.collect()
    assert len(got) == empty + len(groups) + len(nameless)
    assert {r.doc_id for r in got if r.doc_id is not None} >= groups


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.components(df).count() == 0 and jaccard.keep_one(df).count() == 0


@given(st.text(st.sampled_from("aAbÉé \t\n\x0b\x0c\r\x1c　"), max_size=30), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_shingles(text, words):
    assert len(jaccard.shingles(text, words)) == len(sets([(0, text)], words)[0])


def test_connected(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(30)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.label for r in jaccard.connected(df).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[root(a)] = root(b)
    pairs = {(root(x), label.get(x, x)) for e in edges for x in e}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("edges, most", [([(i, i + 1) for i in range(300)], 40),
                                         ([(i, 299 - i) for i in range(150)] + [(i, 300 - i) for i in range(1, 150)], 40)])
def test_chains_take_few_rounds(spark, monkeypatch, edges, most):
    """Tables written, one a step: a round per halving, a step per doubling."""
    written = []
    real = jaccard.table
    monkeypatch.setattr(jaccard, "table", lambda df, name: written.append(name) or real(df, name))
    labels = jaccard.connected(spark.createDataFrame(edges, "a long, b long"))
    assert len({r.label for r in labels.collect()}) == 1 and labels.count() == 301 - (edges[0] != (0, 1))
    assert len(written) <= most


def test_parity_maps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for _ in range(500):
        pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
        a = np.unique(rng.choice(pool, rng.integers(1, 2000)))
        b = np.unique(np.concatenate([rng.choice(a, len(a) // 2 + 1), rng.choice(pool, rng.integers(1, 100))]))
        differ = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_hubs_long_texts_and_flushed_counts(spark, monkeypatch):
    """A star with more partners than one place takes, a group of near copies that mostly don't link
    with one another, and a text of 60,000 words and its near copy."""
    monkeypatch.setattr(jaccard, "PARTNERS", 7)
    monkeypatch.setattr(jaccard, "FLUSH", 10)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(70)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        w[rng.randrange(70)] = f"own{i}"
        rows.append((i, " ".join(w)))
    other = [f"c{i}" for i in range(70)]
    for i in range(100, 150):  # two edits each and no base: few of these link
        w = list(other)
        for _ in range(2):
            w[rng.randrange(70)] = f"own{i}"
        rows.append((i, " ".join(w)))
    long = [rng.choice("abcdefgh") + str(rng.randrange(5000)) for _ in range(60_000)]
    rows += [(900, " ".join(long)), (901, " ".join(long[:59_000])), (902, " ".join(long[:30_000]))]
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=3, num=90)
    want = brute(rows, 3, 90, 100)
    assert sorted(((r.id, r.n_shingles, r.component) for r in got.collect()), key=str) == want
    assert len({c for i, _, c in want if 100 <= i < 150}) > 5


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f.rsplit("/", 1)[-1] for f in files if "/shuffle_" in f}


def test_tables_keep_no_shuffle_files(spark):
    import time

    from pyspark.sql import functions as F

    df = spark.range(20_000).groupBy((F.col("id") % 7_000).alias("k")).count().repartition(3, "count")
    before, was = _shuffle_files(spark), spark.conf.get(store.CLEAN_UP)
    written = store.table(df, "cleaned")
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(store.CLEAN_UP) == was
    assert written.count() == 7_000 and df.count() == 7_000


def test_prefixes_are_removed_once_they_are_indexed(spark, rows, monkeypatch):
    written = {}
    real = jaccard.table

    def spy(df, name):
        written[name] = real(df, name)
        written[name].paths = written[name].inputFiles()
        return written[name]

    monkeypatch.setattr(jaccard, "table", spy)
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    assert jaccard.components(df, words=3, num=90).count() == len(rows)
    long_lists = [name for name, t in written.items() if "prefix" in t.columns]
    assert len(long_lists) == 2
    for name in long_lists:
        assert not any(store.exists(path) for path in written[name].paths), name


def _rows_of_tables(monkeypatch):
    """Rows by name of the tables that the join writes, in order."""
    written, real = [], jaccard.table

    def spy(df, name):
        out = real(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(jaccard, "table", spy)
    return written


def test_a_shared_passage_is_one_pair_of_kinds(spark, monkeypatch):
    """Texts that share a passage of many shingles meet at the first of them, not at each."""
    written = _rows_of_tables(monkeypatch)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"own{i}x{j}" for j in range(12 + i)])) for i in range(12)]
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, num=50)
    assert sorted(((r.id, r.n_shingles, r.component) for r in got.collect()), key=str) == brute(rows, 3, 50, 100)
    rows = [(i, " ".join(passage[:30] + [f"own{i}x{j}" for j in range(32 + i)])) for i in range(24)]
    written.clear()
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string"), words=3, num=30)
    assert sorted(((r.id, r.n_shingles, r.component) for r in got.collect()), key=str) == brute(rows, 3, 30, 100)
    assert sum(n for name, n in written if name == "jaccard-kind-pairs") <= 24 * 25 / 2


def test_near_copies_leave_few_pairs_to_the_last_round(spark, monkeypatch):
    """Chains of near copies, where neither the first nor the last group of a shingle links with most."""
    written = _rows_of_tables(monkeypatch)
    rng, rows = random.Random(5), []
    base = [f"b{i}" for i in range(150)]
    for i in range(150):  # up to six places of twenty differ
        w = list(base)
        for j in rng.sample(range(3, 143, 7), rng.randrange(1, 7)):
            w[j] = f"e{j}"
        rows.append((i, " ".join(w)))
    got = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=3, num=90)
    assert sorted(((r.id, r.n_shingles, r.component) for r in got.collect()), key=str) == brute(rows, 3, 90, 100)
    assert [n for name, n in written if name == "jaccard-pairs"][-1] <= 150


def test_only_the_result_is_left(spark, rows):
    """Tables of the rounds, and what is asked of tasks, go with the call that made them."""
    df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    was = set(_scratch(spark))
    found = jaccard.components(df, words=3, num=90)
    left = set(_scratch(spark)) - was
    assert len(left) == 1 and found.count() == len(rows)
    with pytest.raises(ZeroDivisionError), store.passing(spark):
        1 / 0
    with store.passing(spark) as keep:
        jaccard.keep_one(df)
        kept = keep(store.table(df, "kept"))
    assert len(set(_scratch(spark)) - was - left) == 1 and kept.count() == len(rows)


def _scratch(spark):
    import os

    from warbler.session import app_id, checkpoint_root

    return os.listdir(f"{checkpoint_root(spark).removeprefix('file:')}/warbler/{app_id(spark)}")
