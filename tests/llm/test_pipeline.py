import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, duck
from test_jaccard import _scratch, brute as components
from test_suffix import brute as cuts
from warbler.llm import queries, toxicity
from warbler.llm.mixing import mix
from warbler.llm.store import table
from warbler.session import app_id, checkpoint_root

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(table(stage(spark, out[-1], SMALL), f"test-{name}"))
    return out


def test_columns_stay(stages):
    for frame in stages[1:5]:
        assert frame.columns == stages[0].columns


def test_toxic_documents_go(stages):
    kept = {r.doc_id for r in stages[1].collect()}
    assert kept <= {r.doc_id for r in stages[0].collect()}
    labels = stages[0].sparkSession.read.parquet(f"{SMALL}/labels.parquet").collect()
    clean = [r.doc_id for r in labels if not r.toxic]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_toxic_documents_of_several_languages_go(spark, tmp_dir):
    """Exactly the rows that reach their language's threshold go, nearly all toxic ones among them."""
    rng, rows, labels = random.Random(4), [], []
    for i in range(900):
        lang = ("en", "de")[i % 2]
        words = [rng.choice(("alpha", "beta", "gamma", "delta") if lang == "en" else ("eins", "zwei", "drei", "vier"))
                 + rng.choice("xyz") for _ in range(rng.randint(8, 40))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(("vileword", "nastyword") if lang == "en" else ("fies", "mies")))
        rows.append((i, " ".join(words), lang, f"s{i % 3}", 1))
        labels.append((i, 1, int(toxic)))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scored = toxicity.classify(docs, spark.read.parquet(f"{tmp_dir}/labels.parquet")).collect()
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, tmp_dir).collect()}
    assert kept == {r.doc_id for r in scored if r.score < r.threshold}
    toxic = {i for i, _, t in labels if t}
    assert len(toxic - kept) >= 0.9 * len(toxic)
    assert len(kept - toxic) >= 0.95 * (900 - len(toxic))


def test_toxicity_leaves_no_texts_in_the_shared_folder(spark, tmp_dir):
    """Beside what it returns, the stage keeps a row per document that goes, without the text; rows of
    one id or of none are told apart by text and language."""
    rng, rows, labels = random.Random(6), [], []
    for i in range(600):
        words = [rng.choice(("alpha", "beta", "gamma", "delta")) + rng.choice("xyz") for _ in range(20)]
        if toxic := i % 5 == 0:
            words[3:15:4] = ["vileword"] * 3
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    vile, clean = rows[0][1], rows[1][1]
    rows += [(1, vile, "en", "a", 1), (None, vile, None, "a", 1), (None, clean, None, "a", 1), (None, None, None, None, None),
             (0, vile, "en", "b", 2), (1, clean, "en", "b", 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marked = spark.read.parquet(f"{tmp_dir}/labels.parquet")
    plain = sorted((tuple(r)[:5] for r in toxicity.classify(docs, marked).filter("score < threshold").collect()), key=str)
    was = set(_scratch(spark))
    got = corpus_pipeline.drop_toxic(spark, docs, tmp_dir)
    left = set(_scratch(spark)) - was
    assert sorted(map(tuple, got.collect()), key=str) == plain
    assert (1, vile, "en", "a", 1) not in plain and (1, clean, "en", "b", 2) in plain
    root = f"{checkpoint_root(spark).removeprefix('file:')}/warbler/{app_id(spark)}"
    kept = [spark.read.parquet(f"{root}/{name}") for name in left]
    assert sum(k.count() for k in kept) == len(rows) - len(plain)
    assert {c for k in kept for c, kind in k.dtypes if kind == "string"} <= {"_lang"}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named like
    the ones that stages use inside."""
    names = ("_id _mark _one _rows _rank _size _words _source _sure _more _nth _copies _copy _score _limit _text _n_bytes "
             "_n_removed _n_spans _cuts id mark n task node class key rows").split()
    said = "one two three four five six seven eight nine ten eleven twelve"
    long = " ".join(f"w{i * 7919 % 60_000}" for i in range(60_000))
    rows = [(1, said, "en", "a", 5), (1, said, "en", "a", 5), (2, said, "en", "b", 5), (3, said + " more", "en", None, None),
            (None, said, None, None, None), (None, None, None, "a", None), (4, None, "en", "a", 0), (5, "", "en", "a", 0),
            (6, " \t ", "de", "b", 3), (7, long, "en", "b", len(long)), (8, long + " end", "en", "b", len(long)),
            (9, "word", "en", "c", 4), (9, "word", "en", "c", 4), (10, "another text of a few words", "fr", "c", 27)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for i, name in enumerate(names):
        frame = frame.withColumn(name, F.lit(f"own {i}"))
    return frame.repartition(3)


def test_stages_take_odd_rows(spark, odd):
    docs, seen = table(odd, "odd"), [(len(odd.columns), 14)]
    for name, stage in corpus_pipeline.STAGES:
        docs = table(stage(spark, docs, SMALL), f"odd-{name}")
        if name != "packing":
            assert docs.columns == odd.columns
            got = docs.select([c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]).distinct()
            assert [tuple(r) for r in got.collect()] == [tuple(f"own {i}" for i in range(len(docs.columns) - 5))]
        seen.append((name, docs.count()))
    counts = dict(seen[1:])
    # One of the equal texts of 1, 2, 3 and null, one of the long ones, one "word"; texts without words stay.
    assert counts["ngram_jaccard_join"] == counts["toxicity"] - 6
    assert counts["suffix_array_dedup"] == counts["ngram_jaccard_join"]
    assert counts["packing"] >= counts["mixing"] > 0


def test_stages_take_no_rows(spark, odd):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(odd.limit(0), "none"), SMALL).count() == 0


def test_one_of_each_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    want = {i for i, n, c in components(rows, 5, 80, 100) if n == 0 or i == c}
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(want)


def test_repeats_are_cut(stages):
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    removed = {i: (n, gone) for i, n, gone, _, _ in cuts(rows)}
    got = {r.doc_id: r for r in stages[3].collect()}
    text = dict(rows)
    for i, (n, gone) in removed.items():
        if gone == 0:
            assert got[i].text == text[i]
        elif i in got:
            assert n - gone - 6 <= len(got[i].text.encode()) <= n - gone
            assert got[i].n_chars == len(got[i].text)
        else:
            assert n - gone < 4
    assert any(gone for _, gone in removed.values())


def test_the_mix_is_taken(stages):
    want = {r.id: (r.sure + r.more) for r in mix(stages[3]).collect()}
    got = {}
    for r in stages[4].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in want.items() if n}


def test_all_that_is_left_is_packed(stages):
    pieces = stages[5].collect()
    whole = sum(r.start == 0 for r in pieces)
    assert whole == stages[4].count() and sum(r.length for r in pieces) == sum(
        r.doc_tokens for r in pieces if r.start == 0)


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, SMALL).count() == stages[5].count()


def test_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    ok, message = compare(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.ORACLE_SQL[name])
    assert ok, message
