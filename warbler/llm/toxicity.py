"""Toxicity of texts: a convolutional classifier over hashed word embeddings.

A text is cut into lower-case words at white space and ASCII punctuation. A word's embedding is the
sum of two rows of two hashed tables, so two words are mixed up only if both of their buckets meet.
Filters of 1, 2 and 3 words run over the whole text; each keeps its maximum (ReLU), and a linear
layer and a logistic function make the score. Only words of the text enter the score.

``train`` fits in numpy on the driver by Adagrad, on a sample of labelled rows: ``per_class`` rows
of each label at most (chosen by the hash of the id), of at most ``train_words`` words. Buckets that
fewer than two sampled texts use are set to zero, so words never seen say nothing. A fifth of the
sample's ids takes no part in the fit.

Thresholds come from all labelled rows outside the fit and the held-out fold, long texts included:
they are scored in tasks, and counted by language, label and score (in steps of 1 / ``BINS``). Rows
count for those of their label and kind (short or long) that the fit took, so both labels weigh as in
the whole table at every size. A language's threshold is the one with the best F1 (ties: the highest;
the middle of its gap). A language with fewer than ``least`` toxic rows there has the overall one,
which is 0.5 where all languages together have fewer; all are 0.5 where no model could be fitted.

``score`` sends the model (its size is fixed) to the tasks and scores every text where it is read:
no shuffle. Long texts are run through in pieces, so memory does not follow a text's length.
``classify`` trains and scores with one pass over all texts.

Defined results. Null text: empty; its score is the one of no words. Null or repeated labels: null
labels are no labels, the highest label of an id counts. Null ids are scored and never trained on;
repeated rows are scored each. Without labels of both kinds every score is 0. Columns other than
those named are ignored; the frame's own columns all come back, and clash with none, as the
results are ``score`` and ``threshold`` under names that the caller chooses.
"""

from __future__ import annotations

import string
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from warbler.llm.store import table, tidy

BUCKETS = 1 << 16
WIDTHS = (1, 2, 3)
PAD = max(WIDTHS)
REMEMBERED = 200_000
#: Words run through at once.
CHUNK = 1 << 17
#: Steps of the scores that thresholds are chosen from.
BINS = 1 << 14

_SPACE = str.maketrans({c: " " for c in string.punctuation})
_CODES: dict[str, int] = {}


def codes(text: str) -> list[int]:
    """Two bucket numbers per word, in one integer."""
    import xxhash

    words = text.lower().translate(_SPACE).split()
    known = _CODES
    try:
        return [known[w] for w in words]
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w) & 0xFFFFFFFF
        return [known[w] for w in words]


def flat_codes(texts: list[str]):
    """Codes of all texts end to end, -1 for the padding after each; and where each text starts."""
    pad = [-1] * PAD
    out: list[int] = []
    starts = [0]
    for t in texts:
        out += codes(t)
        out += pad
        starts.append(len(out))
    return np.array(out, np.int64), np.array(starts)


@dataclass
class Model:
    first: np.ndarray  # (BUCKETS + 1, d): the last row is the padding's
    second: np.ndarray
    filters: list[np.ndarray]  # per width w: (w, d, f)
    bias: np.ndarray  # of all filters
    out: np.ndarray
    out_bias: float
    trained: bool = True
    thresholds: dict = field(default_factory=dict)  # by language; None: overall

    @classmethod
    def new(cls, d: int = 8, f: int = 16, seed: int = 1) -> "Model":
        rng = np.random.default_rng(seed)
        table = lambda: rng.normal(0, 0.1, (BUCKETS + 1, d)).astype(np.float32)
        m = cls(table(), table(), [rng.normal(0, 0.5, (w, d, f)).astype(np.float32) for w in WIDTHS],
                np.zeros(f * len(WIDTHS), np.float32),
                rng.normal(0, 0.5, f * len(WIDTHS)).astype(np.float32), 0.0)
        m.first[-1] = m.second[-1] = 0
        return m

    def buckets(self, flat: np.ndarray):
        pad = flat < 0
        a, b = flat & 0xFFFF, (flat >> 16) & 0xFFFF
        a[pad] = b[pad] = BUCKETS
        return a, b

    def embed(self, flat: np.ndarray) -> np.ndarray:
        a, b = self.buckets(flat)
        return self.first[a] + self.second[b]

    def convolve(self, x: np.ndarray, w: int, kernel: np.ndarray) -> np.ndarray:
        """Values of one width at the starts 0 to len(x) - w."""
        n = len(x) - w + 1
        out = x[:n] @ kernel[0]
        for j in range(1, w):
            out += x[j:n + j] @ kernel[j]
        return out

    def pooled(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Maxima of every filter, a row per text."""
        f = self.filters[0].shape[2]
        best = np.full((len(starts) - 1, f * len(WIDTHS)), -np.inf, np.float32)
        for lo in range(0, len(flat), CHUNK):
            hi = min(lo + CHUNK, len(flat))
            x = self.embed(flat[lo:hi + PAD - 1])
            text = np.searchsorted(starts, np.arange(lo, hi), "right") - 1
            left = starts[text + 1] - np.arange(lo, hi)  # words and padding from here on
            cuts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            for i, (w, kernel) in enumerate(zip(WIDTHS, self.filters)):
                v = self.convolve(x, w, kernel)[:hi - lo]
                if len(v) < hi - lo:
                    v = np.concatenate([v, np.full((hi - lo - len(v), f), -np.inf, np.float32)])
                v[left < w] = -np.inf  # a window that runs into the next text
                rows, cols = text[cuts], slice(i * f, (i + 1) * f)
                best[rows, cols] = np.maximum(best[rows, cols], np.maximum.reduceat(v, cuts, axis=0))
        return best

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        flat, starts = flat_codes(texts)
        h = np.maximum(self.pooled(flat, starts) + self.bias, 0)
        z = (h @ self.out + self.out_bias).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(texts: list[str], labels: np.ndarray, epochs: int = 16, batch: int = 32, rate: float = 0.15,
        seed: int = 2) -> Model:
    """Adagrad on the logistic loss, both labels weighing the same in all."""
    m = Model.new()
    if len(set(labels.tolist())) < 2:
        m.trained = False
        return m
    docs = [np.array(codes(t) + [-1] * PAD, np.int64) for t in texts]
    rng = np.random.default_rng(seed)
    share = np.mean(labels)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    f, d = m.filters[0].shape[2], m.first.shape[1]
    squares = {k: np.full_like(v, 1e-3) for k, v in (
        ("first", m.first), ("second", m.second), ("bias", m.bias), ("out", m.out))}
    k_squares, b_square = [np.full_like(k, 1e-3) for k in m.filters], 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            flat = np.concatenate([docs[r] for r in rows])
            ends = np.cumsum([len(docs[r]) for r in rows])
            starts = ends - [len(docs[r]) for r in rows]
            a, b = m.buckets(flat)
            x = m.first[a] + m.second[b]
            peak = np.empty((len(rows), len(m.bias)), np.int64)
            top = np.empty((len(rows), len(m.bias)), np.float32)
            for i, (w, kernel) in enumerate(zip(WIDTHS, m.filters)):
                v = m.convolve(x, w, kernel)
                for r, (lo, hi) in enumerate(zip(starts.tolist(), ends.tolist())):
                    own = v[lo:hi - w + 1]
                    p = own.argmax(0)
                    peak[r, i * f:(i + 1) * f] = lo + p
                    top[r, i * f:(i + 1) * f] = own[p, np.arange(f)]
            h = np.maximum(top + m.bias, 0)
            z = h @ m.out + m.out_bias
            g = ((1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[rows]) * weight[rows]
                 / len(rows)).astype(np.float32)
            g_out, g_bias_out = g @ h, float(g.sum())
            g_top = g[:, None] * m.out * (h > 0)
            g_x = np.zeros_like(x)
            g_kernels = []
            for i, (w, kernel) in enumerate(zip(WIDTHS, m.filters)):
                p, gt = peak[:, i * f:(i + 1) * f], g_top[:, i * f:(i + 1) * f]
                gk = np.empty_like(kernel)
                for j in range(w):
                    gk[j] = np.einsum("rf,rfd->df", gt, x[p + j])
                    np.add.at(g_x, (p + j).ravel(),
                              (gt[:, :, None] * kernel[j].T[None]).reshape(-1, d))
                g_kernels.append(gk)
            used = np.flatnonzero(np.abs(g_x).sum(1))
            for name, table, bucket in (("first", m.first, a), ("second", m.second, b)):
                ids, inverse = np.unique(bucket[used], return_inverse=True)
                ge = np.zeros((len(ids), d), np.float32)
                np.add.at(ge, inverse, g_x[used])
                squares[name][ids] += ge * ge
                table[ids] -= rate * ge / np.sqrt(squares[name][ids])
                table[-1] = 0
            for k, s, gk in zip(m.filters, k_squares, g_kernels):
                s += gk * gk
                k -= 0.3 * rate * gk / np.sqrt(s)
            for name, value, grad in (("out", m.out, g_out), ("bias", m.bias, g_top.sum(0))):
                squares[name] += grad * grad
                value -= 0.3 * rate * grad / np.sqrt(squares[name])
            b_square += g_bias_out ** 2
            m.out_bias -= rate * g_bias_out / np.sqrt(b_square)
    for shift, table in ((0, m.first), (16, m.second)):
        n = np.zeros(BUCKETS + 1, np.int64)
        for x in docs:
            n[np.unique((x[:-PAD] >> shift) & 0xFFFF)] += 1
        table[n < 2] = 0
    return m


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The threshold of the best F1, in the middle of the gap that it lies in."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    last = np.r_[s[1:] != s[:-1], True]  # a threshold can't part equal scores
    i = int(np.argmax(np.where(last, f1, -1)))
    return float((s[i] + (s[i + 1] if i + 1 < len(s) else 0.0)) / 2)


def held_out(key: str = "doc_id"):
    """Rows that are never trained on: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def best_bin(bins: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """``best_threshold`` of weighted counts by score step."""
    steps, at = np.unique(-bins, return_inverse=True)
    hits = np.cumsum(np.bincount(at, toxic))
    f1 = 2 * hits / (hits + np.cumsum(np.bincount(at, clean)) + hits[-1])
    i = int(np.argmax(f1))
    below = 1 - steps[i + 1] if i + 1 < len(steps) else 0
    return float((below - steps[i]) / (2 * BINS))


def short(text: str, train_words: int):
    """Texts that the fit may take."""
    return F.length(F.translate(F.coalesce(F.col(text), F.lit("")), " \t\n", "")) < 8 * train_words


def marked_ids(labels: DataFrame, key: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``id, label`` of the labelled ids that are not held out."""
    return (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
            .groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label")))


def fit_sample(docs: DataFrame, marked: DataFrame, key: str = "doc_id", text: str = "text",
               per_class: int = 5000, train_words: int = 4096):
    """A model of a sample of the marked rows; and the condition on ``id`` and ``label`` for the ids
    whose short texts it was fitted on."""
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    chosen = F.lit(False)
    for value, n in counts.items():
        limit = int(min(1.0, per_class / n) * (1 << 20))
        chosen |= (F.col("label") == value) & (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < limit)
    fitted = chosen & (F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(5)) != 4)
    # At most about per_class ids of each label, and a row of each (the smallest text): a bounded
    # table, and the same one in every run.
    some = F.broadcast(marked.filter(fitted))
    rows = docs.filter(short(text, train_words)).select(
        F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("said"))
    got = (rows.join(some, "id").groupBy("id", "label").agg(F.min("said").alias("said"))
           .orderBy("id").toArrow())
    said, label = got["said"].to_pylist(), got["label"].to_numpy().astype(np.int64)
    del got
    model = fit(said, label)
    del said
    _CODES.clear()  # the driver goes on to other work
    tidy()
    return model, fitted


def thresholds(scored: DataFrame, marked: DataFrame, fitted, least: int = 20) -> dict:
    """Thresholds by language, None for the overall one. ``scored``: ``id, spoken, score, short``."""
    rows = (scored.filter(F.col("id").isNotNull())
            .groupBy("id", "spoken", "short", F.floor(F.col("score") * BINS).alias("bin")).count())
    outside = F.when(fitted & F.col("short"), 0).otherwise(F.col("count"))
    got = (rows.join(marked, "id").groupBy("spoken", "short", "bin", "label")
           .agg(F.sum(outside).alias("outside"), F.sum("count").alias("rows")).toPandas())
    if not len(got):
        return {None: 0.5}
    kinds = got.groupby(["short", "label"])[["outside", "rows"]].transform("sum")
    weight = got["outside"] * kinds["rows"] / kinds["outside"].clip(lower=1)
    is_toxic = got["label"] == 1
    got["toxic"], got["clean"] = weight.where(is_toxic, 0.0), weight.where(~is_toxic, 0.0)
    got["found"] = got["outside"].where(is_toxic, 0)
    got = got[got["outside"] > 0]
    pick = lambda g: best_bin(*(g[c].to_numpy() for c in ("bin", "toxic", "clean")))
    out = {None: pick(got) if got["found"].sum() >= least else 0.5}
    for name, own in got.groupby("spoken"):
        if own["found"].sum() >= least:
            out[name] = pick(own)
    return out


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          lang: str = "lang", label: str = "toxic", per_class: int = 5000, train_words: int = 4096,
          least: int = 20) -> Model:
    marked = marked_ids(labels, key, label)
    model, fitted = fit_sample(docs, marked, key, text, per_class, train_words)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("said"),
                       F.col(lang).cast("string").alias("spoken"), short(text, train_words).alias("short"))
    model.thresholds = thresholds(score(rows, model, "said", "spoken", keep=("id", "spoken", "short")),
                                  marked, fitted, least) if model.trained else {None: 0.5}
    return model


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             lang: str = "lang", label: str = "toxic", per_class: int = 5000, train_words: int = 4096,
             least: int = 20, score_name: str = "score", threshold_name: str = "threshold",
             keep: tuple | None = None) -> DataFrame:
    """``score`` by a model of ``train``, but each text is scored once: the scores are written to the
    shared folder, and the thresholds chosen from there. ``keep``: the columns that come back (all)."""
    marked = marked_ids(labels, key, label)
    model, fitted = fit_sample(docs, marked, key, text, per_class, train_words)
    keep = tuple(keep or docs.columns)
    inner = [f"{score_name}_{c}" for c in ("id", "spoken", "short")]
    rows = docs.select("*", F.col(key).alias(inner[0]), F.col(lang).cast("string").alias(inner[1]),
                       short(text, train_words).alias(inner[2]))
    scored = table(score(rows, model, text, inner[1], score_name, threshold_name, (*keep, *inner)),
                   "toxicity-scored")
    by = thresholds(scored.select(*[F.col(c).alias(n) for c, n in zip(inner, ("id", "spoken", "short"))],
                                  F.col(score_name).alias("score")),
                    marked, fitted, least) if model.trained else {None: 0.5}
    limit = F.lit(by.pop(None))
    if by:
        limit = F.coalesce(F.try_element_at(F.map_from_arrays(F.lit(list(by)), F.lit(list(by.values()))),
                                            F.col(inner[1])), limit)
    return scored.select(*keep, score_name, limit.alias(threshold_name))


def score(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang",
          score_name: str = "score", threshold_name: str = "threshold",
          keep: tuple | None = None) -> DataFrame:
    """``docs`` (the columns ``keep``, or all) with each text's score, and the threshold of its
    language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    where, spoken = columns.index(text), columns.index(lang)
    out = [columns.index(c) for c in keep or columns]
    schema = T.StructType([*(docs.schema.fields[i] for i in out), T.StructField(score_name, T.DoubleType()),
                           T.StructField(threshold_name, T.DoubleType())])

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = pc.fill_null(batch.column(where), "")
            scores = []
            for lo in range(0, len(texts), 500):
                scores.append(m.scores(texts.slice(lo, 500).to_pylist()))
            limits = [m.thresholds.get(x, m.thresholds.get(None, 0.5))
                      for x in batch.column(spoken).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in out),
                 pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                 pa.array(limits, pa.float64())], names=schema.names)
        _CODES.clear()  # the worker goes on to other tasks

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, scored by a model of the labels that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return (classify(docs.select("doc_id", "text", "lang"), labels, keep=("doc_id",))
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold"))
