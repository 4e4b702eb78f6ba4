"""Shortest-path betweenness centrality of a weighted undirected graph, on Spark.

Brandes' algorithm as relational fixpoints over (source s, node v) rows, so every step is a join or
an aggregate and no task ever holds one source's tree:

1. distances: a round sends d(s, u) + w along the arcs of the nodes that changed in the round before,
   keeps the least per (s, v), and writes only the rows that are shorter than what was known.
   Positive weights make it end.
2. shortest-path arcs: the arcs (u, v) with d(s, u) + w = d(s, v). The sums are the same doubles that
   made the distances, so ties count as in Dijkstra-based Brandes.
3. path counts: sigma(s, v) sums, over the number of hops, the walks from s along those arcs. Counts
   start after the distances are final, so no stale distance is ever counted.
4. dependencies: unrolling Brandes' delta(u) = sum over successors v of sigma(u)/sigma(v) *
   (1 + delta(v)) gives delta(u) = sum over k >= 1 of q_k(u), where each arc carries
   a = sigma(u)/sigma(v), q_1(u) = sum of a over u's out-arcs and q_(k+1)(u) = sum of a * q_k(v).

Weights are distances (a larger weight is a longer edge) and must be positive; one so small that
adding it to a distance changes nothing is refused too. Scores are normalised like the common
library default for undirected graphs: times 1/((n-1)(n-2)); no scaling for n <= 2.

Layout. Sources never exchange rows, so they are dealt to blocks once, a block per task, and every
table of a batch is bucketed by block: joins and aggregates of a round find their rows in place, and
**no round has a shuffle**. Arcs come to the blocks as a broadcast where their number is at most
``broadcast_arcs``; beyond that, as a table with a copy for each block, bucketed like the rest. A
copy per block is small against what a block sends in a round: the arcs times its sources.

Graphs of at most ``held_arcs`` arcs need no rounds over tables: a task holds a copy of the edges, dealt
to its block as above, and takes its sources one after the other, with a few numbers per node and arc
(steps 1 to 4 for one source, ``_trees``). So do graphs of at most ``hub_arcs`` arcs whose edges all have
an end among few nodes (``hubs``), which take less of a task's memory and time. What a task holds is bounded
by these numbers of arcs, whatever the number of sources; larger graphs go by rows.

Distances are kept as runs, one more a round; neighbouring runs of like size are merged, so a round
reads a logarithmic number of them. A source without a changed row is finished for good: when half
of the sources of the runs are, their rows are set aside and no later round reads them.

Sources have dense ids and run in batches of equal size, so that one round of a batch sends
``max_batch_rows`` rows at most (a batch has at least one source), ``in_flight`` batches at once, in
a pool of their own each (fair where the cluster schedules fairly). A finished batch publishes its
scores whole, and a run with ``resume`` goes on after the batches that an earlier run finished.
Every round is cut by a Parquet table in the shared folder, which bounds lineage, survives executor
loss and gives the planner true sizes; the tables are removed when the scores are written.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warbler.operators.graph import Graph
from warbler.operators.hubs import MOST_HUBS, hub_trees
from warbler.session import checkpoint_root, default_parallelism, delete_path, scratch_path
from warbler.sources.publish import exists, replace

NODE_SIZE_FACTOR = 5000.0
#: Arcs that are sent to every task at most (three numbers each); more are dealt to blocks as a table.
BROADCAST_ARCS = 2_000_000
#: Arcs of which a task holds a copy at most (each edge once, as two places and a weight).
HELD_ARCS = 2_000_000
#: The same, of graphs with few hubs (about 100 bytes an edge while a task prepares them).
HUB_ARCS = 12_000_000
#: A batch of sources whose arcs are held writes nothing but its scores, and sends the arcs to all tasks
#: again, so it is larger.
HELD_BATCH = 5000
ABSORBED = "an edge weight is too small to count against the distances of its paths"
#: What a row of distances belongs to.
KEYS = ["block", "s", "v"]


class _Cuts:
    """Lineage cuts: tables written as Parquet under one folder in the shared checkpoint location and
    read back, bucketed by ``block`` where they have one. Read-back tables carry sizes from their
    files; a checkpointed DataFrame would instead carry the optimizer's estimate of the plan it came
    from, and with joins that estimate is a product that grows without bound over many rounds."""

    def __init__(self, spark: SparkSession, root: str, blocks: int = 0):
        self.spark, self.root, self.blocks = spark, root, blocks
        self.names: list[str] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        name = f"warbler_{uuid.uuid4().hex}"
        path = f"{self.root}/{name}"
        if "block" not in df.columns:
            df.write.parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)
        self.names.append(name)
        df.write.bucketBy(self.blocks, "block").option("path", path).saveAsTable(name)
        return self.spark.table(name)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(self.spark, self.root)


class _Layers:
    """A bucketed table that grows by layers, each a partition ``k`` of it. (A union of bucketed
    tables would lose their place by block, or worse, seem to keep it.)"""

    def __init__(self, cut: _Cuts):
        self.cut, self.name, self.count = cut, f"warbler_{uuid.uuid4().hex}", 0
        cut.names.append(self.name)

    def add(self, df: DataFrame) -> int:
        """Writes the next layer; returns its number."""
        (df.withColumn("k", F.lit(self.count)).write.mode("append").partitionBy("k")
         .bucketBy(self.cut.blocks, "block").option("path", f"{self.cut.root}/{self.name}")
         .saveAsTable(self.name))
        self.count += 1
        return self.count - 1

    def of(self, *layers: int) -> DataFrame:
        return self.cut.spark.table(self.name).filter(F.col("k").isin(*layers)).drop("k")


class _Runs:
    """Distances as runs of changed rows, the last the newest; a run is a layer of one table."""

    def __init__(self, cut: _Cuts):
        self.table = _Layers(cut)
        self.runs: list[tuple[int, int]] = []  # layer, rows
        self.finished: list[int] = []
        self.sources = 0

    def add(self, changed: DataFrame) -> DataFrame | None:
        """Takes in a round's rows and returns them as written; None if there are none."""
        layer = self.table.add(changed)
        frontier = self.table.of(layer)
        by_source = frontier.groupBy("block", "s").agg(F.count(F.lit(1)).alias("n"))
        rows, sources = by_source.agg(F.sum("n"), F.count(F.lit(1))).first()
        if not rows:
            return None
        self.sources = max(self.sources, sources)
        self.runs.append((layer, rows))
        while len(self.runs) > 1 and 2 * self.runs[-1][1] >= self.runs[-2][1]:
            self._replace(2, self.table.add(self._least([k for k, _ in self.runs[-2:]])))
        if 2 * sources <= self.sources:
            known, active = self.known(), frontier.select("block", "s").distinct()
            done = self.table.add(known.join(active, ["block", "s"], "left_anti"))
            left = self.table.add(known.join(active, ["block", "s"], "left_semi"))
            self.finished.append(done)
            self._replace(len(self.runs), left)
            self.sources = sources
        return frontier

    def _replace(self, last: int, layer: int) -> None:
        self.runs[-last:] = [(layer, self.table.of(layer).count())]

    def _least(self, layers: list[int]) -> DataFrame:
        return self.table.of(*layers).groupBy(*KEYS).agg(F.min("d").alias("d"))

    def known(self) -> DataFrame:
        """The distances of the sources that are not finished."""
        layers = [k for k, _ in self.runs]
        return self._least(layers) if len(layers) > 1 else self.table.of(*layers)

    def all(self) -> DataFrame:
        return self._least([k for k, _ in self.runs] + self.finished)


def _hashed(rows: DataFrame) -> DataFrame:
    """Rows of (block, s, v) that a join holds as a hash table, so that the other, larger side need not
    be sorted: a block has at most its sources times the nodes of them, a part of ``rows_per_partition``."""
    return rows.hint("shuffle_hash")


def _sent(rows: DataFrame, arcs: DataFrame) -> DataFrame:
    """(block, s, u, v, d, c): what each row (block, s, v, d) sends along its arcs."""
    return (rows.withColumnRenamed("v", "u").join(arcs, ["block", "u"] if "block" in arcs.columns else "u")
            .select("block", "s", "u", "v", "d", (F.col("d") + F.col("w")).alias("c")))


def _distances(cut: _Cuts, sources: DataFrame, arcs: DataFrame) -> DataFrame:
    """(block, s, v, d) for every node v reachable from each source s."""
    runs = _Runs(cut)
    frontier = runs.add(sources.select("block", "s", F.col("s").alias("v"), F.lit(0.0).alias("d")))
    while frontier is not None:
        best = _sent(frontier, arcs).groupBy(*KEYS).agg(F.min("c").alias("c"))
        frontier = runs.add(best.join(_hashed(runs.known()), KEYS, "left")
                            .filter(F.col("d").isNull() | (F.col("c") < F.col("d")))
                            .select(*KEYS, F.col("c").alias("d")))
    return cut(runs.all())


def _shortest_arcs(cut: _Cuts, distances: DataFrame, arcs: DataFrame) -> DataFrame:
    """(block, s, u, v): the arcs of all shortest paths."""
    final = _hashed(distances.withColumnRenamed("d", "least"))
    found = cut(_sent(distances, arcs).filter("v != s").join(final, KEYS).filter("c = least")
                .select("block", "s", "u", "v", (F.col("c") == F.col("d")).alias("absorbed")))
    if not found.filter("absorbed").isEmpty():
        raise ValueError(ABSORBED)
    return found.select("block", "s", "u", "v")


def _walk(cut: _Cuts, layer: DataFrame, step) -> DataFrame | None:
    """The rows of the layer and of those that ``step`` makes of it, until one is empty; None if the
    first is."""
    walked, found = _Layers(cut), []
    while True:
        nth = walked.add(layer)
        layer = walked.of(nth)
        if layer.isEmpty():
            return walked.of(*found) if found else None
        found.append(nth)
        layer = step(layer)


def _dependencies(cut: _Cuts, sources: DataFrame, dag: DataFrame) -> DataFrame | None:
    """(id, delta) summed over these sources; None if there are no paths."""
    start = sources.select("block", "s", F.col("s").alias("v"), F.lit(1.0).alias("paths"))
    by_u, from_u = ["block", "s", "u"], F.col("v").alias("u")
    walks = _walk(cut, start, lambda layer: (
        _hashed(layer.select("block", "s", from_u, "paths")).join(dag, by_u)
        .groupBy(*KEYS).agg(F.sum("paths").alias("paths"))))
    sigma = cut(walks.groupBy(*KEYS).agg(F.sum("paths").alias("sigma")))
    shares = cut(dag.join(_hashed(sigma.select("block", "s", from_u, F.col("sigma").alias("su"))), by_u)
                 .join(_hashed(sigma.withColumnRenamed("sigma", "sv")), KEYS)
                 .select("block", "s", "u", "v", (F.col("su") / F.col("sv")).alias("a")))
    layers = _walk(cut, shares.groupBy("block", "s", F.col("u").alias("v")).agg(F.sum("a").alias("q")),
                   lambda layer: (_hashed(layer).join(shares, KEYS)
                                  .groupBy(*by_u).agg(F.sum(F.col("a") * F.col("q")).alias("q"))
                                  .withColumnRenamed("u", "v")))
    if layers is None:
        return None
    return (layers.filter("s != v").groupBy(F.col("v").alias("id"))
            .agg(F.sum("q").alias("delta")))


def _trees(batch: int, batches: int, n: int, labels: list[int]):
    """What a task does with a block; in one piece, so that workers need not have this package."""
    by_hubs = hub_trees()

    def leaving(first: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """The places of the arcs that leave these nodes, of arcs in order of the node they leave."""
        count = first[nodes + 1] - first[nodes]
        return np.repeat(first[nodes] - np.cumsum(count) + count, count) + np.arange(count.sum())

    def different(nodes: np.ndarray, n: int) -> np.ndarray:
        if 16 * len(nodes) < n:
            return np.unique(nodes)
        found = np.zeros(n, bool)
        found[nodes] = True
        return np.flatnonzero(found)

    def tree(s: int, u, v, w, first, into, starts, ends, sent) -> np.ndarray:
        """The distance of every node from s (inf: not reached). A round takes the arcs of the nodes that
        came closer; if those are many, all arcs, in order of the node they enter."""
        d = np.full(len(first) - 1, np.inf)
        d[s] = 0.0
        closer = np.array([s])
        while len(closer):
            if 8 * (first[closer + 1] - first[closer]).sum() < len(u):
                out = leaving(first, closer)
                c, to = d[u[out]] + w[out], v[out]
                less = c < d[to]
                closer = different(to[less], len(d))
                np.minimum.at(d, to[less], c[less])
            else:
                np.take(d, into[0], out=sent, mode="clip")
                sent += into[1]
                best = np.minimum.reduceat(sent, starts)
                less = best < d[ends]
                closer = ends[less]
                d[closer] = best[less]
        return d

    def by_source(n: int, own: np.ndarray, u, v, w) -> np.ndarray | None:
        """The dependencies of these sources, summed per node, of edges given once. None if an arc is too
        small to count against a distance."""
        m = 2 * len(w)
        u, v, w = np.concatenate([u, v]), np.concatenate([v, u]), np.concatenate([w, w])
        order = np.argsort(u, kind="stable")
        u, v, w = u[order], v[order], w[order]
        first = np.searchsorted(u, np.arange(n + 1))
        order = np.argsort(v, kind="stable")
        into = u[order], w[order]
        ends, starts = np.unique(v[order], return_index=True)
        total = np.zeros(n)
        sent, there = np.empty(m), np.empty(m)
        for s in own.tolist():
            d = tree(s, u, v, w, first, into, starts, ends, sent)
            np.take(d, u, out=sent, mode="clip")
            sent += w
            np.take(d, v, out=there, mode="clip")
            on = np.flatnonzero(sent == there)
            on = on[there[on] < np.inf]
            a, b = u[on], v[on]
            if (d[a] == d[b]).any():
                return None
            # A node's arcs are taken when all arcs of shortest paths that enter it have been.
            leave = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=n))])
            missing = np.bincount(b, minlength=n)
            sigma, delta, steps = np.zeros(n), np.zeros(n), []
            sigma[s], ready = 1.0, np.array([s])
            while len(out := leaving(leave, ready)):
                steps.append(out)
                np.add.at(sigma, b[out], sigma[a[out]])
                np.subtract.at(missing, b[out], 1)
                ready = different(b[out][missing[b[out]] == 0], n)
            for out in reversed(steps):
                np.add.at(delta, a[out], sigma[a[out]] / sigma[b[out]] * (1.0 + delta[b[out]]))
            delta[s] = 0.0
            total += delta
        return total

    def run(key: tuple[pa.Scalar, ...], arcs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, delta): the dependencies of a block's sources, summed per node that an arc has. An arc too
        small to count against a distance gives a row without an id."""
        own = np.arange(batch + batches * labels.index(key[0].as_py()), n, batches * len(labels))
        if not len(own):
            return
        parts = [[column.to_numpy() for column in part.select(["u", "v", "w"]).columns] for part in arcs]
        u, v, w = map(np.concatenate, zip(*parts))
        del parts
        names = np.unique(np.concatenate([u, v]))
        if len(names) < n:
            u, v = np.searchsorted(names, u), np.searchsorted(names, v)
            own = np.searchsorted(names, own[np.isin(own, names)])
        total = by_hubs(len(names), own, u, v, w)
        if total is None:
            total = by_source(len(names), own, u.astype(np.int64), v.astype(np.int64), w)
        ids = pa.array([None] if total is None else names, pa.int64())
        yield pa.RecordBatch.from_pydict({"id": ids, "delta": pa.array([0.0] if total is None else total)})

    return run


def _held(cut: _Cuts, arcs: DataFrame, *which) -> DataFrame:
    """(id, delta) summed over the sources of a batch, by tasks that each hold the arcs of their block."""
    part = cut(arcs.groupBy("block").applyInArrow(_trees(*which), "id long, delta double"))
    if not part.filter("id is null").isEmpty():
        raise ValueError(ABSORBED)
    return part.groupBy("id").agg(F.sum("delta").alias("delta"))


def _few_hubs(arcs: DataFrame) -> bool:
    """Whether the ends with more arcs, of all arcs, are few nodes: the hubs that ``hub_trees`` takes."""
    ends = arcs.groupBy("u").agg(F.count(F.lit(1)).alias("arcs"))
    more = (arcs.select("u", "v").join(ends, "u")
            .join(ends.select(F.col("u").alias("v"), F.col("arcs").alias("others")), "v")
            .filter("arcs > others or arcs = others and u > v"))
    return more.select("u").distinct().limit(MOST_HUBS + 1).count() <= MOST_HUBS


def _dense_ids(cut: _Cuts, nodes: DataFrame) -> DataFrame:
    """(node, id) with ids 0 to n - 1, fixed once written: a node's place in its task's share after
    the shares of the tasks before."""
    raw = cut(nodes.select("node").withColumn("raw", F.monotonically_increasing_id()))
    share = F.shiftright("raw", 33)
    # A row per task.
    before = Window.orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    starts = (raw.groupBy(share.alias("share")).agg(F.count(F.lit(1)).alias("rows"))
              .select("share", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    place = F.col("raw").bitwiseAND(F.lit((1 << 33) - 1))
    return raw.withColumn("share", share).join(starts, "share").select(
        "node", (F.col("start") + place).alias("id"))


def _block_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose joins on block and more find their rows in place where
    both sides are dealt by block. Tables are shared with it, settings of the caller's are copied."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def _labels(spark: SparkSession, blocks: int) -> list[int]:
    """A number for each of the blocks, such that no two fall into one bucket of the tables. As many
    rows as a round has tasks."""
    bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(blocks))
    first = (spark.range(64 * blocks + 64).groupBy(bucket.alias("nth"))
             .agg(F.min("id").cast("int").alias("block")))
    return [r.block for r in first.orderBy("nth").collect()]


def _digest(arcs: DataFrame, nodes: DataFrame) -> str:
    """Of the graph, whatever the order of its rows."""
    marks = [F.sum(F.xxhash64(F.lit(k), "src", "dst", "weight").cast("decimal(38,0)")) for k in (0, 1)]
    return "-".join(map(str, (*arcs.agg(F.count(F.lit(1)), *marks).first(), *nodes.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("node").cast("decimal(38,0)"))).first())))


def betweenness(graph: Graph, normalized: bool = True, max_batch_rows: int = 200_000_000,
                rows_per_partition: int = 4_000_000, in_flight: int = 2, resume: str | None = None,
                broadcast_arcs: int = BROADCAST_ARCS, held_arcs: int = 0, hub_arcs: int = 0) -> DataFrame:
    """(node, betweenness) over all sources; nodes on no shortest path score 0.

    ``max_batch_rows`` bounds sources x arcs per batch, ``rows_per_partition`` the rows that one
    task sends in a round. Tasks hold the arcs of a graph of at most ``held_arcs``, or of at most
    ``hub_arcs`` and few hubs, and go by source, in ``HELD_BATCH`` times the batch; 0: always by rows.
    ``resume`` names a folder that keeps the scores of finished batches, for a
    later run over the same graph; the caller removes it."""
    spark = graph.arcs.sparkSession
    checkpoint_root(spark)  # make sure a checkpoint folder is known
    cut = _Cuts(_block_session(spark), scratch_path(spark, "betweenness-rounds"))
    try:
        named = cut(graph.arcs.select("src", "dst", "weight"))
        bad = named.filter(F.col("weight").isNull() | F.isnan("weight") | (F.col("weight") <= 0)).first()
        if bad:
            raise ValueError(f"edge weights must be positive numbers: {bad['src']!r} to "
                             f"{bad['dst']!r} has {bad['weight']}")
        nodes = cut(graph.nodes.select("node"))
        kept = _Kept(cut.spark, resume or f"{cut.root}/kept", named, nodes, cut, resume is not None)
        ids, arcs, n, m = kept.ids, kept.arcs, kept.n, kept.m
        # Distances that overflow are left to the rows, which tell them from nodes not reached.
        held = (0 < m <= max(held_arcs, hub_arcs) and n < 1 << 31
                and math.isfinite(arcs.agg(F.max("w")).first()[0] * n)
                and (m <= held_arcs or _few_hubs(arcs)))
        # Sums over a part of the sources differ by the way they were made.
        kept.way = "held" if held else "scores"
        batches = max(1, min(n, math.ceil(n * m / (max_batch_rows * (HELD_BATCH if held else 1)))))
        # Tasks by the work of a round, in whole waves of the cluster's slots.
        slots = default_parallelism(spark)
        blocks = slots if held else slots * max(1, math.ceil(n * m / batches / rows_per_partition / slots))
        named_blocks = _labels(spark, blocks)
        labels = F.array(*map(F.lit, named_blocks))
        if not held and m <= broadcast_arcs:
            arcs = F.broadcast(arcs)
        else:
            if held:
                arcs = arcs.filter("u < v").select(F.col("u").cast("int"), F.col("v").cast("int"), "w")
            cut.blocks = blocks
            arcs = cut(arcs.withColumn("block", F.explode(labels)).repartition(blocks, "block"))

        def run(batch: int) -> None:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"warbler-{batch % in_flight}")
            own = _Cuts(cut.spark, f"{cut.root}/batch-{batch}", blocks)
            try:
                if held:
                    part = _held(own, arcs, batch, batches, n, named_blocks)
                else:
                    nth = F.pmod(F.floor(F.col("id") / batches), F.size(labels)).cast("int")
                    sources = own(ids.filter(F.col("id") % batches == batch)
                                  .select(F.element_at(labels, nth + 1).alias("block"), F.col("id").alias("s"))
                                  .repartition(blocks, "block"))
                    distances = _distances(own, sources, arcs)
                    part = _dependencies(own, sources, _shortest_arcs(own, distances, arcs))
                kept.publish(batch, batches, part)
            finally:
                own.close()

        left = [b for b in range(batches) if not kept.has(b, batches)]
        with ThreadPoolExecutor(max_workers=in_flight) as pool:
            started = [pool.submit(inheritable_thread_target(spark)(run), b) for b in left]
            for batch in started:
                try:
                    batch.result()
                except BaseException:
                    for other in started:
                        other.cancel()
                    raise
        scale = (1.0 / ((n - 1) * (n - 2)) if n > 2 else 1.0) if normalized else 0.5
        total = kept.scores(batches).groupBy("id").agg(F.sum("delta").alias("delta"))
        scored = ids.join(total, "id", "left").select(
            "node", (F.coalesce(F.col("delta"), F.lit(0.0)) * F.lit(scale)).alias("betweenness"))
        # The scores outlive the round tables, which are removed below.
        final = scratch_path(spark, "betweenness-scores")
        scored.write.parquet(final)
        return spark.read.schema(scored.schema).parquet(final)
    finally:
        cut.close()


class _Kept:
    """What the batches of a graph share, in one folder by the graph's digest: ids, arcs between ids,
    and a folder of scores per finished batch, each there only whole."""

    def __init__(self, spark: SparkSession, folder: str, named: DataFrame, nodes: DataFrame,
                 cut: _Cuts, lasting: bool):
        self.spark, self.way = spark, "scores"
        self.root = f"{folder.rstrip('/')}/{_digest(named, nodes)}" if lasting else folder

        def prepare(path: str) -> None:
            ids = _dense_ids(cut, nodes)
            ids.write.parquet(f"{path}/ids")
            ids = spark.read.parquet(f"{path}/ids")
            (named.join(ids.select(F.col("node").alias("src"), F.col("id").alias("u")), "src")
             .join(ids.select(F.col("node").alias("dst"), F.col("id").alias("v")), "dst")
             .select("u", "v", F.col("weight").cast("double").alias("w"))
             .write.parquet(f"{path}/arcs"))

        if not exists(spark, f"{self.root}/graph"):
            replace(spark, f"{self.root}/graph", prepare)
        self.ids = spark.read.parquet(f"{self.root}/graph/ids")
        self.arcs = spark.read.parquet(f"{self.root}/graph/arcs")
        self.n, self.m = self.ids.count(), self.arcs.count()

    def _path(self, batch: int, batches: int) -> str:
        return f"{self.root}/{self.way}-{batches}/batch-{batch:06d}"

    def has(self, batch: int, batches: int) -> bool:
        return exists(self.spark, self._path(batch, batches))

    def publish(self, batch: int, batches: int, scores: DataFrame | None) -> None:
        if scores is None:
            scores = self.spark.createDataFrame([], "id long, delta double")
        replace(self.spark, self._path(batch, batches), lambda path: scores.write.parquet(path))

    def scores(self, batches: int) -> DataFrame:
        paths = [self._path(b, batches) for b in range(batches)]
        return self.spark.read.schema("id long, delta double").parquet(*paths)


def node_sizes(scores: DataFrame, factor: float = NODE_SIZE_FACTOR) -> DataFrame:
    """(node, betweenness, node_size = betweenness × 5000), the drawing size of each node."""
    return scores.select("node", "betweenness",
                         (F.col("betweenness") * F.lit(factor)).alias("node_size"))
