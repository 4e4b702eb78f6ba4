"""What the vector searches share: which rows take part, blocks of queries, and k best per query.

A vector takes part if its id and vector are not null, it has no null or non-finite component, and
its length is the most common one of the table (ties: the longer).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from warbler.llm.store import table


def select(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"),
                     F.col(vector).cast("array<double>").alias("vec"))


def dimensions(rows: DataFrame) -> int:
    """The most common length; 0 if no row has a vector."""
    row = (rows.filter("id is not null").groupBy(F.size("vec").alias("n")).count().filter("n > 0")
           .orderBy(F.desc("count"), F.desc("n")).first())
    return row["n"] if row else 0


def matrix(ids: pa.Array, vecs: pa.Array, dims: int, zeros: bool = True):
    """Ids and vectors (a row each) that take part; ``zeros``: so do zero vectors."""
    if isinstance(ids, pa.ChunkedArray):
        ids, vecs = ids.combine_chunks(), vecs.combine_chunks()
    right = pc.and_(ids.is_valid(), pc.fill_null(pc.equal(pc.list_value_length(vecs), dims), False))
    ids, vecs = ids.filter(right), vecs.filter(right)
    flat = pc.fill_null(vecs.flatten(), math.nan).to_numpy(zero_copy_only=False)
    x = flat.reshape(len(ids), dims)
    good = np.isfinite(x).all(axis=1)
    if not zeros:
        good &= (x != 0).any(axis=1)
    return ids.to_numpy()[good], x[good]


def distinct_queries(rows: DataFrame) -> DataFrame:
    """One row per id; of several vectors with one id the smallest asks."""
    return rows.filter("id is not null and vec is not null").groupBy("id").agg(F.min("vec").alias("vec"))


def by_blocks(queries: DataFrame, size: int, answer) -> DataFrame | None:
    """The union of what ``answer(block)`` finds for blocks of about ``size`` queries, None without
    any. A block is an Arrow table; it is answered, and its answer written, before the next one comes
    to the driver, so the driver and the tasks hold one block, whatever the number of queries."""
    queries = table(queries, "search-queries")
    blocks = max(1, -(-queries.count() // size))
    dealt, found = F.pmod(F.xxhash64("id"), F.lit(blocks)), None
    for b in range(blocks):
        own = queries.filter(dealt == b).toArrow()
        if own.num_rows:
            part = table(answer(own), "search-found")
            found = part if found is None else found.unionByName(part)
    return found


class Best:
    """The k best (score, id) of each query so far; higher scores first, ties to smaller ids."""

    def __init__(self, queries: int, k: int, dtype):
        self.k = k
        self.query = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.score = np.empty(0, dtype)
        self.least = np.full(queries, -np.inf)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        ids = np.concatenate([self.id, ids])
        score = np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, query))
        query = query[order]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else order
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        keep = rank < self.k
        self.query, self.id, self.score = query[keep], ids[order][keep], score[order][keep]
        full = rank[keep] == self.k - 1
        self.least[self.query[full]] = self.score[full]


def ranked(found: DataFrame, k: int, nearest: bool) -> DataFrame:
    """The k best per query of what the tasks found: ``query_id, rank, id, score``."""
    score = F.col("score").asc() if nearest else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(score, "id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
