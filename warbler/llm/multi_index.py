"""Approximate nearest neighbours by an inverted multi-index.

``fit`` quantises each half of the vectors separately (k-means on a sample of about ``sample`` rows),
so ``cells`` × ``cells`` pairs of centroids divide the space. ``assign`` puts every row of the table
into its pair. A query goes through the pairs by summed distance with a heap, until the pairs it has
seen hold enough different vectors, and all their rows are reranked by the exact distance.

How many are enough follows from the data: ``fit`` searches its sample by brute force for some of its
own rows, and takes the share of the sample that holds ``recall`` of their neighbours in order of the
summed distance. In a larger table neighbours are nearer, so the share errs on the safe side. Vectors
that lie in clusters need a small share; noise in many dimensions needs a large one.

The index is the table dealt out and sorted by ranges of (pair, id), so a pair that holds a third of
the table is spread over tasks; it is written once, and its rows stay where they are. Queries are sent
to the tasks in blocks of about ``block``, one block after the other. What a query's heap has gone
through is told by one number, the summed distance of the last pair: rows of a task's next pairs
are compared to the queries that reach one of them, with one matrix product, and a task keeps the k
best of each query. Equal vectors count once, so copies don't end a search early.

The centroids and the pairs' counts are sent to the tasks: ``cells`` is at most 1024, so they are
1024² counts at most, whatever the table holds.

Defined results. See ``vectors`` for the rows that take part; zero vectors do not. A query never
finds its own id. Repeated rows are candidates each; one id asks once. Ties go to the smaller id.
Fewer candidates than k in the whole table: all. Empty frames give no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from warbler.llm.store import table
from warbler.llm.vectors import Best, by_blocks, dimensions, distinct_queries, matrix, ranked, select

MOST_CELLS = 1024
ENTRIES = "pair int, id long, vec array<double>"
ASKED = "id long, vec array<double>, radius double"
FOUND = "query_id long, id long, score double"


@dataclass
class Index:
    """Centroids of the two halves (of all zeros where a half has no components)."""

    dims: int
    halves: tuple[np.ndarray, np.ndarray]
    share: float = 1.0

    @property
    def cells(self) -> int:
        return len(self.halves[0])

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        cut = self.dims // 2
        return [squared(part, c) for part, c in zip((x[:, :cut], x[:, cut:]), self.halves)]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None, :], 0)


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centroids; fewer different rows than k are their own."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = squared(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def fit(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
        cells: int | None = None, sample: int = 20_000, recall: float = 0.96, k: int = 10) -> Index | None:
    """An index fitted on about ``sample`` rows chosen by the hash of their id; None if no row takes
    part. ``cells``: centroids of a half; by default the table's size decides. ``recall``: the share
    of the ``k`` nearest that a search should find."""
    rows = select(vectors, key, vector)
    dims = dimensions(rows)
    if not dims:
        return None
    n = rows.filter("id is not null").count()
    share = min(1.0, sample / n)
    # The smallest hashes of ids, so that runs agree; a bound on the hash spares sorting the table.
    hashed = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    x = np.empty((0, dims))
    for most in (share, 1.0):
        chosen = (rows.withColumn("hash", hashed).filter(F.col("hash") < math.ceil(most * (1 << 40)))
                  .orderBy("hash", "id", "vec").limit(2 * sample).toArrow())
        _, x = matrix(chosen["id"], chosen["vec"], dims, zeros=False)
        if len(x) or most == 1.0:
            break
    if not len(x):
        return None
    cells = cells or int(min(MOST_CELLS, max(4, round(math.sqrt(n / 4)))))
    cut = dims // 2
    index = Index(dims, (k_means(x[:, :cut], cells), k_means(x[:, cut:], cells)))
    index.share = _share(index, np.unique(x, axis=0), recall, k)
    return index


def _share(index: Index, x: np.ndarray, recall: float, k: int, queries: int = 256) -> float:
    """The share of ``x`` that holds ``recall`` of the nearest, in order of the summed distances."""
    if len(x) <= k + 1:
        return 1.0
    a, b = (d.argmin(1) for d in index.distances(x))
    places = []
    for i in range(0, len(x), max(1, len(x) // queries)):
        exact = squared(x[i:i + 1], x)[0]
        exact[i] = np.inf
        first, second = (d[0] for d in index.distances(x[i:i + 1]))
        rank = np.empty(len(x), np.int64)
        rank[np.argsort(first[a] + second[b], kind="stable")] = np.arange(len(x))
        places.append(rank[np.argpartition(exact, k)[:k]])
    return float((np.quantile(np.concatenate(places), recall) + 1) / len(x))


def assign(vectors: DataFrame, index, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every row that takes part with its ``pair`` of centroids."""

    def run(batches):
        model = index.value
        for batch in batches:
            ids, x = matrix(batch["id"], batch["vec"], model.dims, zeros=False)
            a, b = (d.argmin(1) for d in model.distances(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array((a * len(model.halves[1]) + b).astype(np.int32)), pa.array(ids),
                 _lists(x)], names=["pair", "id", "vec"])

    return select(vectors, key, vector).mapInArrow(run, ENTRIES)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))


def search(vectors: DataFrame, queries: DataFrame, index: Index | None, k: int = 10,
           key: str = "vec_id", vector: str = "embedding", candidates: int | None = None,
           block: int = 2048) -> DataFrame:
    """``query_id, rank, id, score``: the nearest rows each query finds, by Euclidean distance."""
    spark = vectors.sparkSession
    nothing = spark.createDataFrame([], "query_id long, rank int, id long, score double")
    if index is None:
        return nothing
    sc = spark.sparkContext
    model = sc.broadcast(index)
    entries = table(assign(vectors, model, key, vector).repartitionByRange("pair", "id")
                    .sortWithinPartitions("pair", "id"), "multi-index")
    sizes = entries.groupBy("pair").agg(F.approx_count_distinct(F.xxhash64("vec")).alias("distinct")).toArrow()
    weight = np.zeros(index.cells * len(index.halves[1]), np.int64)
    weight[sizes["pair"].to_numpy()] = sizes["distinct"].to_numpy()
    if candidates is None:
        candidates = max(1000, math.ceil(index.share * weight.sum()))
    asked = distinct_queries(select(queries, key, vector)).mapInArrow(
        _reach(sc.broadcast((index, weight, candidates))), ASKED)

    def answer(block: pa.Table) -> DataFrame:
        x = block["vec"].combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1)
        shared = sc.broadcast((index, block["id"].to_numpy(), x, block["radius"].to_numpy()))
        return entries.mapInArrow(_rerank(shared, k), FOUND)

    found = by_blocks(asked, block, answer)
    return nothing if found is None else ranked(found, k, nearest=True)


def nearest_pairs(first: np.ndarray, second: np.ndarray, weight: np.ndarray, enough: int) -> list[int]:
    """Pairs of centroids that hold rows, by summed distance, until they hold ``enough``. A heap
    holds the frontier: (i, j) in order of distance has (i+1, j) and (i, j+1) behind it."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    fa, sb, al, bl = first[a].tolist(), second[b].tolist(), a.tolist(), b.tolist()
    heap, seen, out, held = [(fa[0] + sb[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        pair = al[i] * len(bl) + bl[j]
        if weight[pair]:
            out.append(pair)
            held += int(weight[pair])
        for i2, j2 in ((i + 1, j), (i, j + 1)):
            if i2 < len(al) and j2 < len(bl) and (i2, j2) not in seen:
                seen.add((i2, j2))
                heapq.heappush(heap, (fa[i2] + sb[j2], i2, j2))
    return out


def _reach(shared):
    """Queries with the summed distance of the last pair that their heap goes through."""

    def run(batches):
        index, weight, enough = shared.value
        for batch in batches:
            ids, x = matrix(batch["id"], batch["vec"], index.dims, zeros=False)
            first, second = index.distances(x)
            radius = np.full(len(ids), -1.0)
            for i in range(len(ids)):
                if pairs := nearest_pairs(first[i], second[i], weight, enough):
                    a, b = divmod(pairs[-1], len(index.halves[1]))
                    radius[i] = first[i][a] + second[i][b]
            yield pa.RecordBatch.from_arrays([pa.array(ids), _lists(x), pa.array(radius)],
                                             names=["id", "vec", "radius"])

    return run


def _rerank(shared, k: int):
    """Entries, sorted by pair, against the queries that reach their pairs."""

    def run(batches):
        index, query_ids, q, radius = shared.value
        first, second = index.distances(q)
        # Distances are worked out in other batches than the radius was: rounding may not lose a pair.
        radius = (radius + 1e-9 * (first.max(1) + second.max(1)))[:, None]
        best = Best(len(q), k, np.float64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                ids, x = part["id"].to_numpy(), part["vec"].flatten().to_numpy().reshape(part.num_rows, -1)
                a, b = np.divmod(part["pair"].to_numpy(), len(index.halves[1]))
                wanted = first[:, a] + second[:, b] <= radius
                who = np.flatnonzero(wanted.any(1))
                rows = np.flatnonzero(wanted.any(0))
                if len(who):
                    _compare(best, who, query_ids[who], q[who], wanted[np.ix_(who, rows)], ids[rows], x[rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[best.query]), pa.array(best.id), pa.array(-best.score)],
            names=["query_id", "id", "score"])

    return run


def _compare(best: Best, who: np.ndarray, query_ids, q, wanted, ids, x) -> None:
    """Adds to ``best`` (of negative distances) what the queries ``who`` find among the wanted rows."""
    d = squared(q, x)
    d[~wanted | (query_ids[:, None] == ids[None, :])] = np.inf
    # The k nearest by the rounded distances, and all that rounding may hide among them.
    slack = 1e-9 * ((q * q).sum(1) + (x * x).sum(1).max())
    limit = np.partition(d, best.k - 1, axis=1)[:, best.k - 1] if d.shape[1] > best.k else np.inf
    limit = np.minimum(limit, best.least[who] ** 2) + slack
    r, c = np.nonzero((d <= limit[:, None]) & np.isfinite(d))
    for at in range(0, len(r), 1 << 16):
        rr, cc = r[at:at + (1 << 16)], c[at:at + (1 << 16)]
        exact = np.sqrt(((q[rr] - x[cc]) ** 2).sum(1))
        ok = -exact >= best.least[who[rr]]
        best.add(who[rr[ok]], ids[cc[ok]], -exact[ok])


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vec_id divisible by 100 against all ``embeddings``: the ten nearest found."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found = search(vectors, vectors.filter(F.col("vec_id") % 100 == 0), fit(vectors), k=10)
    return found.withColumnRenamed("id", "vec_id")
