import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from warbler.llm import perplexity
from warbler.llm.store import table


def split(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_counts(text):
    text = text or ""
    words = split(text)
    lines = [x for x in text.split("\n") if split(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(repeated))


class Model:
    """Interpolated modified Kneser-Ney over the characters of words, by the book."""

    def __init__(self, texts, order):
        self.order = order
        self.levels = [None] * (order + 1)
        top = Counter(g for t in texts for w in split(t) for g in self.grams(w))
        self.levels[order] = top
        for k in range(order - 1, 0, -1):
            self.levels[k] = Counter(g[1:] for g in self.levels[k + 1])
        self.stats = [None] + [self.stat(level) for level in self.levels[1:]]

    def grams(self, word):
        padded = " " * (self.order - 1) + word + " "
        return [padded[i:i + self.order] for i in range(len(word) + 1)]

    @staticmethod
    def stat(level):
        n = [sum(c == j for c in level.values()) for j in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        if all(n[1:]):
            y = n[1] / (n[1] + 2 * n[2])
            for j in (1, 2, 3):
                x = j - (j + 1) * y * n[j + 1] / n[j]
                d[j] = x if 0 < x < j else d[j]
        by_context = defaultdict(list)
        for g, c in level.items():
            by_context[g[:-1]].append(c)
        return d, {h: (sum(cs), sum(d[min(c, 3)] for c in cs) / sum(cs)) for h, cs in by_context.items()}

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.levels[1]) + 1)
        d, contexts = self.stats[k]
        if gram[:-1] not in contexts:
            return self.p(gram[1:])
        total, weight = contexts[gram[:-1]]
        c = self.levels[k].get(gram, 0)
        return (c - d[min(c, 3)]) / total + weight * self.p(gram[1:])

    def score(self, text):
        grams = [g for w in split(text) for g in self.grams(w)]
        return len(grams), math.fsum(math.log(self.p(g)) for g in grams) if grams else None


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    parts = {"en": ["th", "an", "ed", "e", "ing", "or"], "de": ["ch", "ü", "en", "sch", "ß", "er"]}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "de"])
        words = ["".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(0, 90))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words), lang))
    return rows + [(3, rows[3][1], "en"), (3, rows[3][1], "en"), (None, "no id here", "en"), (100, None, "en"),
                   (101, "", None), (102, "no language\nno language", None), (103, "# $$$ <b>\n \n# $$$ <b>\n漢字 \x00 a", "en"),
                   (104, "a b c d a b c a b", "en"), (105, "long " * 4000, "de"), (106, "x" * 50_000, "de"),
                   (107, "no language ''", "")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "p") for r in rows],
                                 "doc_id long, text string, lang string, n long, gram string")


@pytest.mark.parametrize("order, block_bytes, parts", [(5, 1 << 24, 1), (3, 500, 3), (2, 1, 2)])
def test_scores_are_those_of_the_book(docs, rows, order, block_bytes, parts):
    got = perplexity.score(table(docs.repartition(parts), "test"), order=order, block_bytes=block_bytes).collect()
    models = {x: Model([t for _, t, lang in rows if (lang or "") == x], order) for x in ("en", "de", "")}
    want = []
    for key, text, lang in rows:
        predicted, logp = models[lang or ""].score(text)
        want.append((str(key), lang or "", *brute_counts(text), predicted, logp))
    got = sorted((str(r.key), *r[1:]) for r in got)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:-1] == b[:-1]
        assert (a[-1] is None) == (b[-1] is None)
        assert a[-1] is None or a[-1] == pytest.approx(b[-1], rel=1e-5)


def test_probabilities_sum_to_one(spark, docs):
    order = 4
    model = perplexity.fit(perplexity.block_grams(docs, order=order), order)
    chars = [r.gram for r in model[0][0].filter("lang = 'en'").collect()] + ["☃"]
    for context in ("   ", "  t", "the", "zzz"):
        asked = spark.createDataFrame([("en", context + c) for c in chars], "lang string, gram string")
        got = perplexity.probabilities(asked, model)
        assert got.agg(F.sum("p")).first()[0] == pytest.approx(1)


def test_other_documents_back_off(spark, docs, rows):
    order = 4
    model = perplexity.fit(perplexity.block_grams(docs, order=order), order)
    other = [(1, "thing unheard ☃", "en"), (2, "the\nthe", "en"), (3, "words", "fr"), (4, "", "de")]
    got = perplexity.score(spark.createDataFrame(other, "doc_id long, text string, lang string"), order=order, model=model)
    own = Model([t for _, t, lang in rows if lang == "en"], order)
    by_key = {r.key: r for r in got.collect()}
    for key, text, _ in other[:2]:
        assert (by_key[key].predicted, by_key[key].logp) == (own.score(text)[0], pytest.approx(own.score(text)[1], rel=1e-5))
    assert by_key[3].logp is None and by_key[4].logp is None and by_key[3].n_words == 1


def test_repeated_words():
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(4) for _ in range(rng.randint(0, 30))]
        text = " ".join("abcd"[i] for i in ids)
        assert perplexity.repeated_words(np.array(ids, np.int64)) == brute_counts(text)[4]
    big = np.array([1 << 40, 5, 1 << 41, 7, 1 << 40, 5, 1 << 41], np.int64)
    assert perplexity.repeated_words(big) == 6


def test_bands_reject_outliers_and_count_copies_once(spark):
    rng = random.Random(3)
    rows = [(i, "en", 100, 500 + i, 600, -600 * rng.gauss(2, 0.1)) for i in range(2000)]
    rows += [(9000 + i, "en", 100, 501, 600, -600 * 2.3) for i in range(1500)]  # copies
    rows += [(1, "xx", 60, 1, 10, -20.0)]
    frame = spark.createDataFrame(rows, "key long, lang string, n_words long, word_chars long, predicted long, logp double")
    got = {r.lang: r for r in perplexity.bands(frame).collect()}
    assert 1.5 < got["en"].least < 1.7 and 2.3 < got["en"].most < 2.5
    assert got["xx"].least < 2 < got["xx"].most


def test_query(spark, tmp_dir):
    rng = random.Random(5)
    parts = ["th", "an", "ed", "e", "ing", "or"]
    rows = [(i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(rng.randint(60, 120))), "en")
            for i in range(200)]
    rows += [(500, "XQZ!! VVK@@ " + " ".join("".join(rng.choices("QXZJKV!@", k=6)) for _ in range(80)), "en"),
             (501, "short text", "en"), (502, "again and again " * 40, "en"), (503, None, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = perplexity.op12_quality_rules(spark, tmp_dir)
    assert [f"{n} {t}" for n, t in got.dtypes[:8]] == [
        "doc_id bigint", "n_words bigint", "word_chars bigint", "n_symbols bigint", "n_dup_lines bigint",
        "n_repeat_words bigint", "base_failed boolean", "kept boolean"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert len(by_id) == len(rows)
    for key, text, _ in rows:
        r = by_id[key]
        want = brute_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)
    assert [k for k, r in by_id.items() if not r.kept and not r.base_failed] == [500]
    assert {501, 502, 503} <= {k for k, r in by_id.items() if r.base_failed}


def test_no_documents(spark):
    assert perplexity.judge(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
