"""Ranked lexical search over documents by accumulator-limited, term-at-a-time scoring.

Items (the queries) are answered in blocks with a bounded number of distinct terms. For a block:

1. one scan of the documents counts each document's terms and its occurrences of the block's terms,
   and writes them as a table (``n``, ``terms``, ``tfs``): everything below reads only that;
2. Spark sums the corpus' statistics: documents with a term (N), all their terms (L), and by term
   the documents that hold it (df). As many numbers as the block has terms go to the driver;
3. tasks score the documents they read, ``shard`` documents at once, from postings sorted by term.
   An item's terms are taken rarest first. A document gets an accumulator when a term is found in
   it, as long as a document without one could still be among the best: the bound of the terms to
   come (the greatest contribution of each in this shard) is not below the k-th best score so far,
   counting the task's earlier shards and partial scores of this one, which only grow. After that,
   terms only update the accumulators there are, exactly;
4. each task gives k documents an item at most, and Spark ranks them in two steps: within groups of
   tasks, then over the groups. So no task gets the rows of all tasks for an item.

Terms are runs of bytes that are ASCII letters or digits or belong to a character beyond ASCII,
with A-Z lower-cased. All scoring is in 64-bit integers but for the logarithm of a weight.

Defined results. Null text has no terms; items without terms, and items no term of which is in a
document, give no rows. Rows of items with one id are one item with the terms of all. Rows of
documents with one id are documents of their own; null ids rank after others of equal score. An
empty table on either side gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from warbler.llm.store import table

#: Every byte to a lower-case term byte or to a space (terms are a fixed value of the format).
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
#: Bytes of a text that are split at once.
PIECE = 1 << 22

POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "task int, item int, doc_id long, score long"


def terms(text: bytes):
    """Lists of the terms of a text, in order; a long text in several lists."""
    at = 0
    while at < len(text):
        piece = text[at:at + PIECE].translate(TERM_BYTES)
        if at + PIECE < len(text):  # the last term may go on in the next piece
            cut = piece.rfind(b" ") + 1
            more = PIECE
            while not cut:
                more *= 2
                piece = text[at:at + more].translate(TERM_BYTES)
                cut = piece.rfind(b" ") + 1 if at + more < len(text) else len(piece)
            piece = piece[:cut]
        yield piece.split()
        at += len(piece)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def saturation(tf: np.ndarray, n: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 8 * m) with m = 10 + (90 * n * N) div L."""
    if len(n) and 90 * int(n.max()) * documents >= 1 << 63:
        m = 10 + np.array([90 * int(x) * documents // all_terms for x in n.tolist()], np.int64)
    else:
        m = 10 + 90 * n.astype(np.int64) * documents // all_terms
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Shard:
    """The postings of some documents by term, with the saturation of each."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, tf: np.ndarray, n: np.ndarray,
                 documents: int, all_terms: int):
        doc = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(term, kind="stable")  # by term, then by document
        self.doc = doc[order]
        self.value = saturation(tf[order], n[self.doc], documents, all_terms)
        self.terms, self.start = np.unique(term[order], return_index=True)
        self.end = np.append(self.start[1:], len(order))
        self.most = (np.maximum.reduceat(self.value, self.start) if len(order)
                     else np.empty(0, np.int64))
        self.scores = np.zeros(len(sizes), np.int64)

    def best(self, query: list[tuple[int, int]], k: int, least: int, counted: dict | None = None):
        """(documents, scores) of those that can be among the k best. ``query``: (term, weight),
        rarest first. ``least``: a score that k other documents reach already (0: none)."""
        at = np.searchsorted(self.terms, [t for t, _ in query])
        lists = [(i, w) for i, (t, w) in zip(at.tolist(), query)
                 if i < len(self.terms) and self.terms[i] == t and w > 0]
        bounds = np.array([w * int(self.most[i]) for i, w in lists], np.int64)
        left = np.append(np.cumsum(bounds[::-1])[::-1], 0)  # of this term and those after it
        scores, live = self.scores, None
        seen = []
        for place, (i, w) in enumerate(lists):
            docs = self.doc[self.start[i]:self.end[i]]
            values = self.value[self.start[i]:self.end[i]]
            if live is None:
                if place and left[place] < left[0]:
                    live = self._enough(seen, k, max(least, 1), int(left[place]))
                elif least > left[0]:
                    live = np.empty(0, np.int64)  # no document of this shard can be among them
            if live is None:
                scores[docs] += w * values
                seen.append(docs)
            elif len(live) * 8 < len(docs):
                where = np.minimum(np.searchsorted(docs, live), len(docs) - 1)
                hit = docs[where] == live
                scores[live[hit]] += w * values[where[hit]]
            elif len(live):
                hit = scores[docs] > 0
                scores[docs[hit]] += w * values[hit]
            if counted is not None:
                counted["updated"] = counted.get("updated", 0) + 1
                counted["limited"] = counted.get("limited", 0) + (live is not None)
        if live is None:
            live = np.unique(np.concatenate(seen)) if seen else np.empty(0, np.int64)
        got = scores[live]
        for docs in seen:
            scores[docs] = 0
        keep = got >= max(least, 1)
        return live[keep], got[keep]

    def _enough(self, seen: list, k: int, least: int, left: int):
        """The documents with an accumulator if no other can be among the k best, else None."""
        if left < least:
            return np.unique(np.concatenate(seen))
        have = np.unique(np.concatenate(seen))
        if len(have) < k:
            return None
        partial = self.scores[have]
        kth = int(np.partition(partial, len(partial) - k)[-k])
        return have if left < kth else None


def _counter(numbers: dict[bytes, int]):
    def run(batches):
        names = [c.split()[0] for c in POSTINGS.split(", ")]
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            sizes, ids, tfs, counts = [], [], [], []
            for i in range(batch.num_rows):
                n, found = 0, Counter()
                for words in terms(texts[i].as_py() or b""):
                    n += len(words)
                    found.update(filter(numbers.__contains__, words))
                counts.append(n)
                sizes.append(len(found))
                ids += [numbers[w] for w in found]
                tfs += found.values()
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(counts, pa.int64()),
                 *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (ids, tfs))],
                names=names)

    return run


def _scorer(queries: list, documents: int, all_terms: int, k: int, shard: int):
    def run(batches):
        best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in queries]
        task, held, rows = 0, [], 0

        def score():
            whole = pa.Table.from_batches(held).combine_chunks()
            n = whole["n"].to_numpy()
            keys = whole["doc_id"].combine_chunks()
            nulls = keys.is_null().to_numpy(zero_copy_only=False)
            keys = keys.fill_null(0).to_numpy()
            lists, tfs = whole["terms"].combine_chunks(), whole["tfs"].combine_chunks()
            part = Shard(lists.value_lengths().to_numpy(), lists.flatten().to_numpy(),
                         tfs.flatten().to_numpy(), n, documents, all_terms)
            for q, (_, query) in enumerate(queries):
                had = best[q]
                least = int(had[1][-1]) if len(had[1]) == k else 0
                docs, got = part.best(query, k, least)
                if len(docs):
                    ids, values, none = (np.concatenate(x) for x in zip(
                        had, (keys[docs], got, nulls[docs])))
                    order = np.lexsort((ids, none, -values))[:k]
                    best[q] = ids[order], values[order], none[order]

        for batch in batches:
            if batch.num_rows:
                task = batch["task"][0].as_py()
                held.append(batch)
                rows += batch.num_rows
                if rows >= shard:
                    score()
                    held, rows = [], 0
        if held:
            score()
        for (item, _), (ids, values, none) in zip(queries, best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), task), pa.int32()),
                     pa.array(np.full(len(ids), item), pa.int32()),
                     pa.array(ids, pa.int64(), mask=none), pa.array(values, pa.int64())],
                    names=["task", "item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text", block_terms: int = 500_000,
           shard: int = 20_000) -> DataFrame:
    """(``item_id``, ``rank`` from 1, ``doc_id``, ``score``): the k best documents of each item with
    a score above 0. Items are answered in blocks of at most ``block_terms`` terms (an item with
    more is a block of its own), as the driver and every task hold the terms of a block."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_key).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    # An item's number is its place among the ids: a row per item.
    numbered = table(asked.groupBy("item_id").agg(F.collect_set("text").alias("texts"))
                     .withColumn("item", F.row_number().over(
                         Window.orderBy(F.col("item_id").asc_nulls_last()))), "search-items")
    found = [_search_block(spark, rows, block, k, shard) for block in _blocks(numbered, block_terms)]
    if not found:
        found = [spark.createDataFrame([], "item int, rank int, doc_id long, score long")]
    ranked = found[0]
    for more in found[1:]:
        ranked = ranked.unionByName(more)
    return (ranked.join(numbered.select("item", "item_id"), "item")
            .select("item_id", "rank", "doc_id", "score"))


def _blocks(numbered: DataFrame, block_terms: int):
    """Blocks of items: {item: terms}. The items come to the driver one after the other."""
    block, size = {}, 0
    for row in numbered.orderBy("item").toLocalIterator():
        own = {w for text in row.texts for words in terms(text.encode()) for w in words}
        if not own:
            continue
        if block and size + len(own) > block_terms:
            yield block
            block, size = {}, 0
        block[row.item] = own
        size += len(own)
    if block:
        yield block


def _search_block(spark: SparkSession, rows: DataFrame, block: dict, k: int, shard: int) -> DataFrame:
    numbers = {w: i for i, w in enumerate(sorted(set().union(*block.values())))}
    postings = table(rows.mapInArrow(_counter(numbers), POSTINGS), "search-postings")
    total = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    # At most as many rows as the block has terms.
    df = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    queries = []
    for item, own in block.items():
        known = sorted((df[i], i) for i in map(numbers.get, own) if i in df)  # rarest first
        queries.append((item, [(i, weight(d, total.documents)) for d, i in known]))
    scored = postings.withColumn("task", F.spark_partition_id()).mapInArrow(
        _scorer(queries, total.documents, total.terms or 1, k, shard), FOUND)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod("task", F.lit(max(1, math.isqrt(postings.rdd.getNumPartitions()))))
    rank = F.row_number()
    return (scored.withColumn("group", group)
            .withColumn("rank", rank.over(Window.partitionBy("item", "group").orderBy(*order)))
            .filter(F.col("rank") <= k)
            .withColumn("rank", rank.over(Window.partitionBy("item").orderBy(*order)))
            .filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best ``documents`` for each ``benchmark`` item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search(docs, items)


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
c AS (SELECT count(*) AS nd, sum(len(ts)) AS l FROM d WHERE len(ts) > 0),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
o AS (SELECT r, doc_id, len(ts) AS n, unnest(ts) AS t FROM d),
p AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, t, count(*) AS tf
      FROM o WHERE t IN (SELECT t FROM i) GROUP BY r, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, c GROUP BY t),
s AS (
  SELECT item_id, r, any_value(p.doc_id) AS doc_id,
         sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * nd) // l))))) AS score
  FROM i JOIN p USING (t) JOIN w USING (t), c GROUP BY item_id, r),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM k WHERE rank <= 10
"""
