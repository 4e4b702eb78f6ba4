"""Exact top-k search by multi-resolution segment statistics.

A vector of n components is cut into s equal segments (the last may be padded with zeros). With L
components, mean m and standard deviation d per segment, u(x) = (√L·m, √L·d for every segment) has
the length of x, and |u(x) − u(q)| is never above the distance of x and q. So

    u(x)·u(q)  =  (|x|² + |q|² − |u(x) − u(q)|²) / 2  ≥  x·q

bounds the inner product from above through a lower-bound distance. A task holds a block of queries
and goes through its rows batch by batch. A pair whose bound at 1, 2, 4, … segments is below the
query's k-th best so far is dropped, coarse to fine; the exact measure is computed for the pairs that
are left. Every pair is bounded, none is skipped, so the result is exact.

Rows stay where they are read; the queries are sent to the tasks in blocks of about ``block``, one
block after the other (whatever their number), and a task returns k rows a query. ``survivors`` tells
how many pairs are left after each resolution.

Scores are inner products of the vectors turned into integers floor(scale·x), in exact integer
arithmetic; a score beyond 64 bits is held at the ends of their range.

Defined results. See ``vectors`` for the rows that take part. Zero vectors do. A query never finds
its own id. Repeated rows are candidates each; one id asks once. Ties go to the smaller id. Fewer
candidates than k: all. Empty frames give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from warbler.llm.vectors import Best, by_blocks, dimensions, distinct_queries, matrix, ranked, select

FOUND = "query_id long, id long, score long"


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """u(x) at a number of segments, a row per vector."""
    n = -(-x.shape[1] // segments)
    if n * segments > x.shape[1]:
        x = np.pad(x, ((0, 0), (0, n * segments - x.shape[1])))
    parts = x.reshape(len(x), segments, n)
    return np.concatenate([parts.mean(axis=2), parts.std(axis=2)], axis=1) * np.sqrt(n)


def resolutions(dims: int) -> list[int]:
    """1, 2, 4, … segments, as long as a segment has four components."""
    out = [1]
    while out[-1] * 8 <= dims:
        out.append(out[-1] * 2)
    return out


def integers(x: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(x * scale)


def small(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether doubles hold the inner products of these whole numbers exactly."""
    return np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < 2.0 ** 53


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the paired rows of two matrices of whole numbers."""
    if small(a, b):
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    lo, hi = -(1 << 63), (1 << 63) - 1
    return np.array([max(lo, min(hi, sum(int(x) * int(y) for x, y in zip(r, s))))
                     for r, s in zip(a.tolist(), b.tolist())], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id",
          vector: str = "embedding", scale: float = 256.0, block: int = 4096) -> DataFrame:
    """``query_id, rank, id, score``: each query's k highest inner products over ``vectors``."""
    spark = vectors.sparkSession
    rows = select(vectors, key, vector)
    dims = dimensions(rows)
    asked = distinct_queries(select(queries, key, vector))
    sc = spark.sparkContext

    def answer(block: pa.Table) -> DataFrame:
        shared = sc.broadcast(matrix(block["id"], block["vec"], dims))
        return rows.mapInArrow(_search(shared, dims, k, scale), FOUND)

    found = by_blocks(asked, block, answer) if dims else None
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    return ranked(found, k, nearest=False)


def survivors(x: np.ndarray, q: np.ndarray, k: int) -> list[int]:
    """How many pairs of rows of ``x`` and of ``q`` their bounds leave, at each resolution, with each
    query's k-th best inner product known: the least that any order of the rows leaves."""
    exact = x @ q.T
    least = np.partition(exact, len(x) - k, axis=0)[len(x) - k] - 1e-6 if len(x) >= k else np.full(len(q), -np.inf)
    alive, out = np.ones(exact.shape, bool), []
    for s in resolutions(x.shape[1]):
        alive &= statistics(x, s) @ statistics(q, s).T >= least
        out.append(int(alive.sum()))
    return out


def _search(queries, dims: int, k: int, scale: float):
    def run(batches):
        query_ids, q = queries.value
        q = integers(q, scale)
        if not len(q):
            return
        levels = resolutions(dims)
        q_stats = [statistics(q, s) for s in levels]
        q_norm = np.sqrt((q * q).sum(axis=1))
        best = Best(len(q), k, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids, x = matrix(part["id"], part["vec"], dims)
                if not len(x):
                    continue
                x = integers(x, scale)
                # Rounding of the bounds is far below this.
                slack = 1e-9 * np.sqrt((x * x).sum(axis=1)).max() * q_norm + 1e-6
                least = best.least - slack
                pairs = None
                for s, of_q in zip(levels, q_stats):
                    of_x = statistics(x, s)
                    if pairs is None or len(pairs[0]) > 0.1 * len(x) * len(q):
                        alive = of_x @ of_q.T >= least
                        if pairs is not None:
                            alive &= before
                        before, pairs = alive, np.nonzero(alive)
                    else:
                        r, c = pairs
                        ok = np.einsum("ij,ij->i", of_x[r], of_q[c]) >= least[c]
                        pairs = r[ok], c[ok]
                r, c = pairs
                other = ids[r] != query_ids[c]
                r, c = r[other], c[other]
                at_once = x @ q.T if len(r) > 0.1 * len(x) * len(q) and small(x, q) else None
                for at in range(0, len(r), 1 << 17):
                    rr, cc = r[at:at + (1 << 17)], c[at:at + (1 << 17)]
                    if at_once is None:
                        score = inner(x[rr], q[cc])
                    else:
                        score = at_once[rr, cc].astype(np.int64)
                    ok = score >= best.least[cc]
                    best.add(cc[ok], ids[rr[ok]], score[ok])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[best.query]), pa.array(best.id), pa.array(best.score)],
            names=["query_id", "id", "score"])

    return run


def op8_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vec_id divisible by 50 against all ``embeddings``: the five highest inner products."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)
    return found.withColumnRenamed("id", "vec_id")


#: The same by brute force.
OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0
),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
