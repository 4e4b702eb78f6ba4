import hashlib
import random
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from warbler.llm import mixing, toxicity, warc
from warbler.llm.store import open_stream


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(6)
    big = "<p>" + "word " * 400
    out = [(i, f"http://x/{i}", rng.choice([big, "short", f"{i}" * 600, big + "é"])) for i in range(120)]
    return out + [(500, "http://u\r\nX: y", "é" * 600), (501, None, None), (None, "n", big), (500, "v", "é" * 600),
                  (502, "", ""), (503, "long", "z" * 3_000_000)]


def test_archives_round_trip(spark, pages):
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    path = warc.write_archives(df.repartition(4), sample_bytes=20_000)
    got = warc.read_archives(spark, path).collect()
    kept = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 1000:
            kept[html] = max(kept.get(html, i), i)
    want = []
    for i, _, html in pages:
        raw = (html or "").encode()
        refers = kept.get(html) if len(raw) >= 1000 and kept.get(html) != i else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if refers else "response", refers))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    for row in spark.read.parquet(f"{path}/index").collect():
        with open_stream(row.file) as f:
            data = f.read()
        magic, size = struct.unpack("<II", data[:8])
        assert magic == warc.MAGIC
        # Each record is a frame of its own.
        assert data[8 + size:].count(struct.pack("<I", warc.ZSTD_MAGIC)) >= row.records + 1
        words = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
        first = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)).decompressobj()
        assert first.decompress(data[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_archives_empty(spark, pages):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(df)).count() == 0


def fill(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in target]
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(target.values())


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "b", "é", "zz", None]))
            for i in range(3000)]
    rows += [(9, "w w w", "hot")] * 900 + [(None, None, "a"), (None, "x y z", "tiny")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id long, text string, source string, size int, rows string")

    def run(d):
        m = mixing.mix(d).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        return sorted(((r.id, r.size, r.source, r.target, r.size * (r.sure + (r.row <= r.more)))
                       for r in m.collect()), key=str)

    got = run(df.repartition(5))
    assert got == run(df.repartition(2))
    assert len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for i, size, source, target, took in got:
        sizes[source] = sizes.get(source, 0) + size
        taken[source] = taken.get(source, 0) + took
        largest[source] = max(largest.get(source, 0), size)
        assert took <= 2 * size and (not size or took % size == 0)
    want = fill(sizes)
    for _, _, source, target, _ in got:
        assert target == pytest.approx(want[source])
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source]


def test_the_fold_keeps_words_and_expectations(spark):
    n = 4000
    items = spark.range(n).select(
        F.array(*[F.struct(F.rand(i).alias("draw"), F.lit(i).alias("id"), F.lit(s).cast("long").alias("size"),
                           F.lit(1).cast("long").alias("rows"), F.lit(0).cast("long").alias("sure"),
                           F.lit(0).cast("long").alias("more"), F.lit(p).alias("p"))
                  for i, (s, p) in enumerate([(10, .3), (25, .8), (4, .5), (60, .25), (7, .9)])]).alias("items"))
    met = items.select(F.expr(mixing.MEET).alias("m")).select("m.c", "m.done").collect()
    mean, start = np.zeros(5), 10 * .3 + 25 * .8 + 4 * .5 + 60 * .25 + 7 * .9
    for r in met:
        every = [*r.done, r.c]
        assert sum(x["size"] * x.p for x in every) == pytest.approx(start)
        assert all(x.p in (0.0, 1.0) for x in r.done) and 0 <= r.c.p <= 1
        for x in every:
            mean[x.id] += x.p / n
    assert np.abs(mean - [.3, .8, .5, .25, .9]).max() < 0.03


def test_mixing_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).count() == 0


def test_words(spark):
    texts = ["", None, "a", " a\tb c\x0bd ", "\x1c", "x" * 99 + " y" * 9999]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.words("text")).collect()] == [0, 0, 1, 3, 1, 10000]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    usual = [f"w{i}" for i in range(400)]
    bad = {"en": ["moron", "scum"], "de": ["loweiü", "Trottel"]}
    docs, labels = [], []
    for i in range(1500):
        lang, toxic = rng.choice(["en", "de"]), int(rng.random() < .25)
        w = rng.choices(usual, k=rng.randint(1, 200))
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w) + 1), rng.choice(bad[lang]))
        docs.append((i, " ".join(w), lang, 1))
        labels.append((i, toxic))
    docs += [(None, "moron scum " * 3, "en", 1), (2000, None, None, 1), (2001, "", "xx", 1), (5, docs[5][1], "en", 1),
             (2002, "fine " * 300_000 + "scum moron", "en", 1)]
    labels += [(3, None), (None, 1), (7, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, label int"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels, per_class=600)
    got = toxicity.score(docs, model).withColumn("held", toxicity.held_out()).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id not in (None, 3, 7)}
    held = [r for r in got if r.held and r.doc_id in truth]
    assert len(held) > 200
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.97
    assert np.mean([(r.score >= r.threshold) == truth[r.doc_id] for r in held]) > 0.97
    by = {r.doc_id: r for r in got}
    assert by[2000].score == by[2001].score < 0.5 and by[2002].score > 0.5 and by[None].score > 0.5
    assert not by[None].held and {"en", "de"} <= set(model.thresholds)
    assert all(0 <= r.score <= 1 for r in got) and len(got) == docs.count()


def test_scores_do_not_follow_the_pieces(labelled, monkeypatch):
    model = toxicity.fit(["a b moron", "c d e", "x moron", "y z"] * 5, np.array([1, 0, 1, 0] * 5))
    texts = ["", "a", "a moron b c d e f g h", "q " * 100, "moron"]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "CHUNK", 5)
    assert np.allclose(model.scores(texts), whole)


def test_toxicity_without_labels(labelled):
    docs, labels = labelled
    model = toxicity.train(docs, labels.filter("toxic = 1"))
    assert {r.score for r in toxicity.score(docs.limit(5), model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_best_threshold():
    assert toxicity.best_threshold(np.array([.9, .8, .3, .1]), np.array([1, 1, 0, 0])) == pytest.approx(.55)


def test_thresholds_weigh_the_whole_table(spark):
    """Whatever share of a label the fit took, the threshold is that of the table's own mix."""
    rng = np.random.default_rng(2)
    n = 6000
    toxic = rng.random(n) < .1
    scores = np.round(np.clip(rng.normal(np.where(toxic, .6, .4), .15), 0, 1), 3)
    scored = spark.createDataFrame([(i, "en", float(s), True) for i, s in enumerate(scores)],
                                   "id long, spoken string, score double, short boolean")
    marked = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "id long, label int")
    whole = toxicity.best_threshold(scores, toxic.astype(int))
    got = toxicity.thresholds(scored, marked, F.lit(False))
    assert got["en"] == pytest.approx(whole, abs=.001)
    most = (F.col("label") == 1) & (F.col("id") % 3 > 0)  # two of three toxic rows, no clean one
    skewed = toxicity.thresholds(scored, marked, most)
    assert skewed["en"] == skewed[None] == pytest.approx(whole, abs=.04)


def test_thresholds_come_from_all_rows_outside_the_fit(spark):
    """A sample of 40 rows of a label has too few of a language; the table has enough."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(1200):
        bad = int(i % 4 == 0)
        w = [f"w{rng.randrange(50)}" for _ in range(9)] + ["scum"] * (2 * bad)
        docs.append((i, " ".join(w) + " x" * (20_000 if i % 40 == 0 else 0), "de" if i % 3 else "en"))
        labels.append((i, bad))
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels, per_class=40)
    assert {None, "en", "de"} == set(model.thresholds)
    want = {r.doc_id: (r.score, r.threshold) for r in toxicity.score(docs, model).collect()}
    got = toxicity.classify(docs, labels, per_class=40)
    assert got.columns == ["doc_id", "text", "lang", "score", "threshold"]
    rows = {r.doc_id: r for r in got.collect()}
    for i, (s, limit) in want.items():
        assert rows[i].score == pytest.approx(s, abs=1e-6) and rows[i].threshold == pytest.approx(limit)


def test_a_repeated_id_is_one_row_of_the_sample(spark):
    """One text 400 times and 60 others, sampled by 20 ids a label: no row is cut, no label lost."""
    rows = [(0, "moron scum", "en")] * 400 + [(i, f"scum w{i % 7}" if i % 2 else f"w{i % 7} w{i % 5}", "en")
                                              for i in range(1, 61)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 2 or i == 0)) for i in range(61)], "doc_id long, toxic int")
    marked = spark.createDataFrame([(i, int(i % 2 or i == 0)) for i in range(61)], "id long, label int")
    sizes = []
    real = toxicity.fit
    try:
        toxicity.fit = lambda texts, y: sizes.append((len(texts), set(y.tolist()))) or real(texts, y)
        toxicity.fit_sample(docs, marked, per_class=20)
    finally:
        toxicity.fit = real
    assert sizes[0][0] <= 61 and sizes[0][1] == {0, 1}
    only = toxicity.train(docs, labels.filter("toxic = 1"), least=1)
    assert only.thresholds == {None: 0.5}
    got = toxicity.classify(docs, labels.filter("toxic = 1"), least=1)
    assert got.filter("score < threshold").count() == len(rows)
