"""Quality rules: counts of a text's words, lines and repeats, and n-gram perplexity in bands.

The language model predicts the characters of words: n-grams of ``order`` characters that end in
each character of a word and in its end, with the word's start as their first context. Words are
made of few parts, so what a corpus of any size has to count, and a block of documents has to look
up, are its different n-grams, a small share of its words (different pairs of words, by contrast,
are almost as many as the words).

1. Count. Tasks cut the documents they read into blocks of about ``block_bytes`` and write each
   block's different n-grams with their number, by language. Spark sums them over all blocks: every
   document counts, whole.
2. Model. Interpolated modified Kneser-Ney, one per language, in Spark SQL: counts at the top,
   numbers of different characters before an n-gram below; three discounts a level from the numbers
   of n-grams counted once to four times; the back-off weight of each context. Level by level this
   gives the probability of every n-gram that was seen; of one that was not, by back-off.
3. Serve. The n-grams that a block asks for are joined to the model; each block gets its part of it
   as a sorted hash array (64-bit hashes and logarithms) in a file of its own in the shared folder.
   No task holds the model, and what a block gets is bounded by its text.
4. Score. Tasks read the documents again, block by block: a binary search for each different n-gram,
   sums by word, sums by document. A block is known by its place and a checksum of its n-grams; if
   the input changed or was split otherwise in between, its file is missing and the job fails.
5. Bands. By language, the logarithms of the perplexities of all documents that pass the base rules
   are counted in bins (equal documents once), and the band is the median and a number of spreads
   on either side of it. Documents outside of it are rejected.

Defined results. Null or empty text: no words and no perplexity. Rows without a language are a
language of their own, "". Repeated rows are rows of their own, and count in the model as often. An
empty frame gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from warbler.llm.store import create, exists, folder, table, view

#: What separates words, besides the space (a fixed value of the contract).
SPACES = b"\t\n\x0b\x0c\r "
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

GRAMS = "block long, lang string, gram string, n long"
SCORES = ("key long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, predicted long, logp double")
ANSWER = np.dtype([("key", "<u8"), ("logp", "<f4")])
#: Bins of the logarithm of perplexity.
BIN = 0.005
#: Discounts where the numbers of n-grams counted once to four times do not give any.
FALLBACK = (0.5, 1.0, 1.5)


# -- a block of documents --------------------------------------------------------------------------

def _hashes(codes: np.ndarray, lang: str) -> np.ndarray:
    """A 64-bit hash of each row of code points."""
    seed = np.uint64(zlib.crc32(lang.encode()) << 32 | zlib.adler32(lang.encode()))
    h = np.full(len(codes), seed, np.uint64)
    for j in range(codes.shape[1]):
        h = (h ^ codes[:, j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Words:
    """The different words of one language in a block, and their n-grams."""

    def __init__(self, lang: str, order: int):
        if order < 2:
            raise ValueError("an n-gram of the model has two characters at least")
        self.lang, self.order = lang, order
        self.number: dict[bytes, int] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        number = self.number
        return np.array([number.setdefault(w, len(number)) for w in words], np.int64)

    def close(self) -> None:
        """Works out the n-grams: ``keys`` (sorted hashes), ``at`` (of each prediction, its place
        there), ``first`` (of each word, its first prediction)."""
        pad = b" " * (self.order - 1)
        stream = pad + pad.join(self.number) + pad
        codes = np.frombuffer(stream.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        codes = np.where(codes == 0, np.uint32(0xFFFD), codes)
        space = codes == 32
        ends = np.flatnonzero(~space[1:] | ~space[:-1]) + 1  # a character, or the first space after
        ends = ends[ends >= self.order - 1]
        windows = codes[ends[:, None] + np.arange(1 - self.order, 1)]
        self.keys, place, self.at = np.unique(_hashes(windows, self.lang), return_index=True,
                                              return_inverse=True)
        self.windows = windows[place]
        begins = np.flatnonzero(~space[1:] & space[:-1]) + 1
        self.first = np.searchsorted(ends, begins)

    def grams(self) -> list[str]:
        rows = np.ascontiguousarray(self.windows.astype("<u4"))
        return rows.view(f"<U{self.order}").ravel().tolist()

    def counts(self, uses: np.ndarray) -> np.ndarray:
        sizes = np.diff(np.append(self.first, len(self.at)))
        return np.bincount(self.at, weights=np.repeat(uses, sizes), minlength=len(self.keys))


class Block:
    def __init__(self, order: int):
        self.order = order
        self.words: dict[str, Words] = {}
        self.rows: list[tuple] = []  # key, language, word numbers, counts of the text
        self.bytes = 0

    def add(self, key, lang: str | None, text: bytes, counts: tuple = ()) -> None:
        lang = lang or ""
        if lang not in self.words:
            self.words[lang] = Words(lang, self.order)
        self.rows.append((key, lang, self.words[lang].ids(text.split()), counts))
        self.bytes += len(text)

    def close(self, task: int, nth: int) -> int:
        """Works out the n-grams; the number the block is known by."""
        check = 0
        for lang in sorted(self.words):
            if self.words[lang].number:
                self.words[lang].close()
                check = zlib.crc32(self.words[lang].keys.tobytes(), check)
            else:
                del self.words[lang]
        return ((task * 1_000_003 + nth) % (1 << 31) << 32) | check


def _read(batches, order: int, block_bytes: int, counted: bool):
    """(task, block) by block."""
    task, block = 0, Block(order)
    for batch in batches:
        if not batch.num_rows:
            continue
        task = batch["task"][0].as_py()
        texts = batch["text"].cast(pa.large_binary())
        for i, (key, lang) in enumerate(zip(batch["key"].to_pylist(), batch["lang"].to_pylist())):
            text = texts[i].as_py() or b""
            block.add(key, lang, text, _text_counts(text) if counted else ())
            if block.bytes >= block_bytes:
                yield task, block
                block = Block(order)
    if block.rows:
        yield task, block


def _text_counts(text: bytes) -> tuple[int, int, int]:
    """Characters in words, symbols, and lines with a word that equal an earlier line."""
    chars = len(text.translate(None, SPACES + CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return chars, symbols, len(lines) - len(set(lines))


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """How many words lie in windows of ``width`` words that are found twice or more."""
    if len(ids) < width + 1:
        return 0
    ranks = ids
    for j in range(1, width):  # a window is numbered by the window that is one shorter, and a word
        if int(ranks.max() + 1) * int(ids.max() + 1) >= 1 << 62:
            ranks = np.unique(ranks, return_inverse=True)[1]
        ranks = ranks[:len(ids) - j] * (ids.max() + 1) + ids[j:]
    order = np.argsort(ranks, kind="stable")
    equal = ranks[order[1:]] == ranks[order[:-1]]
    if not equal.any():
        return 0
    found = np.zeros(len(ids) + 1, np.int64)
    hit = np.union1d(order[1:][equal], order[:-1][equal])
    found[hit] += 1
    found[hit + width] -= 1
    return int((np.cumsum(found) > 0).sum())


# -- counting and the model ------------------------------------------------------------------------

def _rows(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"),
                       F.spark_partition_id().alias("task"))


def block_grams(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                order: int = 5, block_bytes: int = 16 << 20) -> DataFrame:
    """(block, lang, gram, n): the different n-grams of each block and language."""
    def run(batches):
        for nth, (task, block) in enumerate(_read(batches, order, block_bytes, False)):
            number = block.close(task, nth)
            for name, words in block.words.items():
                uses = np.bincount(np.concatenate([ids for _, other, ids, _ in block.rows
                                                   if other == name]), minlength=len(words.number))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(words.keys), number)),
                     pa.array([name] * len(words.keys), pa.string()),
                     pa.array(words.grams(), pa.string()),
                     pa.array(words.counts(uses).astype(np.int64))],
                    names=["block", "lang", "gram", "n"])

    return table(_rows(docs, key, text, lang).mapInArrow(run, GRAMS), "quality-grams")


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def _discounts(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3, types): the modified Kneser-Ney discounts of a level, by language."""
    n = level.groupBy("lang").agg(*[F.count_if(F.col("c") == j).cast("double").alias(f"n{j}")
                                    for j in range(1, 5)], F.count(F.lit(1)).alias("types"))
    given = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def of(j: int) -> Column:
        d = j - (j + 1) * y * F.try_divide(F.col(f"n{j + 1}"), F.col(f"n{j}"))
        return F.when(given & (d > 0) & (d < j), d).otherwise(F.lit(FALLBACK[j - 1])).alias(f"d{j}")
    return n.select("lang", of(1), of(2), of(3), "types")


def fit(grams: DataFrame, order: int = 5) -> list[tuple[DataFrame, DataFrame]]:
    """The model's levels, 1 to ``order``: (lang, gram, p) of the n-grams seen, and (lang, context,
    weight, unseen) of their contexts: the weight of the level below, and what a character that
    level 1 has not seen gets."""
    top = grams.groupBy("lang", "gram").agg(F.sum("n").alias("c"))
    levels = [table(top, f"quality-counts-{order}")]
    for k in range(order - 1, 0, -1):
        below = levels[0].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(
            F.count(F.lit(1)).alias("c"))
        levels.insert(0, table(below, f"quality-counts-{k}"))
    model: list[tuple[DataFrame, DataFrame]] = []
    for k, level in enumerate(levels, 1):
        discounts = table(_discounts(level), "quality-discounts")
        rows = level.join(discounts, "lang").withColumn("context", F.substring("gram", 1, k - 1))
        contexts = table(
            rows.groupBy("lang", "context").agg(
                F.sum("c").alias("total"),
                (F.sum(_discount(F.col("c"))) / F.sum("c")).alias("weight"),
                (1 / (F.max("types") + 1)).alias("unseen")), f"quality-contexts-{k}")
        own = (F.col("c") - _discount(F.col("c"))) / F.col("total")
        rows = rows.join(contexts, ["lang", "context"])
        if k == 1:
            p = own + F.col("weight") * F.col("unseen")
            seen = rows.select("lang", "gram", p.alias("p"))
        else:
            below = model[-1][0].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
            seen = (rows.withColumn("suffix", F.substring("gram", 2, k - 1))
                    .join(below, ["lang", "suffix"])
                    .select("lang", "gram", (own + F.col("weight") * F.col("q")).alias("p")))
        model.append((table(seen, f"quality-model-{k}"), contexts))
    return model


def probabilities(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, p) of n-grams the model need not have seen. Languages it does not know are
    left out."""
    order = len(model)
    langs = model[0][1].select("lang", F.col("weight").alias("w0"), "unseen")
    asked = grams.select("lang", "gram").distinct().join(langs, "lang")
    p = F.col("w0") * F.col("unseen")
    for k in range(1, order + 1):
        seen, contexts = model[k - 1]
        part = F.expr(f"right(gram, {k})")
        asked = (asked.withColumn("part", part).withColumn("context", F.substring(part, 1, k - 1))
                 .join(seen.select("lang", F.col("gram").alias("part"), F.col("p").alias(f"p{k}")),
                       ["lang", "part"], "left")
                 .join(contexts.select("lang", "context", F.col("weight").alias(f"w{k}")),
                       ["lang", "context"], "left").drop("part", "context"))
        # A context that was never seen leaves all to the level below.
        p = F.coalesce(f"p{k}", (F.coalesce(f"w{k}", F.lit(1.0)) if k > 1 else F.lit(1.0)) * p)
    return asked.select("lang", "gram", p.alias("p"))


# -- scoring ---------------------------------------------------------------------------------------

def _serve(grams: DataFrame, known: DataFrame, order: int) -> str:
    """Writes each block's part of the model; returns the folder."""
    spark = grams.sparkSession
    path = folder(spark, "quality-answers")

    def write(batches):
        block, parts = None, []

        def close():
            whole = np.concatenate(parts)
            whole.sort(order="key")
            with create(f"{path}/{block}.bin") as out:
                out.write(whole.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(whole)])],
                                              names=["block", "n"])

        for batch in batches:
            blocks, langs = batch["block"].to_numpy(), np.array(batch["lang"].to_pylist(), object)
            codes = np.frombuffer("".join(batch["gram"].to_pylist()).encode("utf-32-le"), np.uint32)
            codes = codes.reshape(-1, order)
            answers = np.empty(len(blocks), ANSWER)
            answers["logp"] = batch["logp"].to_numpy()
            for lang in set(langs):
                own = langs == lang
                answers["key"][own] = _hashes(codes[own], lang)
            for b in np.unique(blocks).tolist():  # sorted by block
                if b != block and parts:
                    yield close()
                    parts = []
                block = b
                parts.append(answers[blocks == b])
        if parts:
            yield close()

    asked = grams.join(known, ["lang", "gram"]).select(
        "block", "lang", "gram", F.log("p").cast("float").alias("logp"))
    written = asked.repartition("block").sortWithinPartitions("block").mapInArrow(
        write, "block long, n long")
    table(written, "quality-served")
    return path


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          order: int = 5, block_bytes: int = 16 << 20, model=None) -> DataFrame:
    """A row per document: ``key``, ``lang``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``predicted`` (characters and word ends), ``logp`` (their
    summed log-probability; null without words, or where ``model``, of ``fit``, does not know the
    language). Without a model, the documents' own is used."""
    grams = block_grams(docs, key, text, lang, order, block_bytes)
    known = fit(grams, order)[-1][0] if model is None else probabilities(grams, model)
    path = _serve(grams, known, order)
    partial = model is not None

    def run(batches):
        for nth, (task, block) in enumerate(_read(batches, order, block_bytes, True)):
            uri = f"{path}/{block.close(task, nth)}.bin"
            if block.words and not (partial or exists(uri)):
                raise RuntimeError(f"{uri} is missing: the documents were read otherwise before")
            answers = view(uri, ANSWER) if exists(uri) else np.empty(0, ANSWER)
            keys, logs = np.array(answers["key"]), np.array(answers["logp"], np.float64)
            by_word = {}
            for name, words in block.words.items():
                where = np.searchsorted(keys, words.keys)
                where[where == len(keys)] = 0
                if not len(keys) or (keys[where] != words.keys).any():
                    if not partial:
                        raise RuntimeError(f"{uri} lacks n-grams of language {name!r}")
                    continue
                sums = np.add.reduceat(logs[where][words.at], words.first)
                by_word[name] = sums, np.diff(np.append(words.first, len(words.at)))
            out = []
            for k, name, ids, counts in block.rows:
                scored = len(ids) and name in by_word
                logp = float(by_word[name][0][ids].sum()) if scored else None
                predicted = int(by_word[name][1][ids].sum()) if scored else 0
                out.append((k, name, len(ids), *counts, repeated_words(ids), predicted, logp))
            kinds = [pa.int64(), pa.string()] + [pa.int64()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                names=[c.split()[0] for c in SCORES.split(", ")])

    return _rows(docs, key, text, lang).mapInArrow(run, SCORES)


def bands(scores: DataFrame, below: float = 5.0, above: float = 5.0, least_spread: float = 0.02
          ) -> DataFrame:
    """(lang, least, most): the band of the logarithm of perplexity by language. The spreads are the
    distances from the median to the 16th and the 84th percentile, ``least_spread`` at least; the
    band reaches ``below`` and ``above`` times as far. Equal documents (by all counts) count once."""
    bins = (scores.select("lang", "n_words", "word_chars", "predicted", "logp").distinct()
            .select("lang", F.floor(-F.col("logp") / F.col("predicted") / BIN).alias("bin"))
            .groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("docs")))
    # A row per bin: logarithms of perplexity span some thousand bins at most.
    by_lang = Window.partitionBy("lang")
    reached = F.sum("docs").over(by_lang.orderBy("bin"))
    share = bins.select("lang", ((F.col("bin") + 0.5) * BIN).alias("x"),
                        (reached / F.sum("docs").over(by_lang)).alias("share"))
    q = share.groupBy("lang").agg(*[F.min(F.when(F.col("share") >= s, F.col("x"))).alias(n)
                                    for s, n in ((0.16, "low"), (0.5, "mid"), (0.84, "high"))])
    mid = F.col("mid")
    return q.select("lang",
                    (mid - below * F.greatest(mid - F.col("low"), F.lit(least_spread))).alias("least"),
                    (mid + above * F.greatest(F.col("high") - mid, F.lit(least_spread))).alias("most"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options
          ) -> DataFrame:
    """The rows of ``score`` with ``base_failed`` (fewer than 50 words, or more than half of them in
    repeated windows of three), ``log_perplexity``, ``least``, ``most`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scores = table(score(docs, key, text, lang, **options).withColumn("base_failed", failed),
                   "quality-scores")
    limits = table(bands(scores.filter(~F.col("base_failed") & F.col("logp").isNotNull())),
                   "quality-bands")
    x = (-F.col("logp") / F.col("predicted")).alias("log_perplexity")
    joined = scores.select("*", x).join(limits, "lang", "left")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("least"), F.col("most")), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & inside)


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the perplexity bands over all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return judge(docs).select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "lang", "log_perplexity", "least", "most")
