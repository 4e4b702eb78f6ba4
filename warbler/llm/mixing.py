"""Mixing sources to target weights: pivotal dependent rounding as a distributed reduction tree.

Every source gets a share of the mix by weight, stopped at ``most`` times its size; what is above is
reshared by weight among the others (``targets``). A document of a source with target t and size s is
taken t/s times on average: floor(t/s) times for sure, and once more with a probability p that is the
fraction. The extra copies are rounded together, so that their words don't add up to chance:

- Two documents of sizes a and b with probabilities p and q meet. Either words go from the second to
  the first, as many as make p one or q zero, or from the first to the second, as many as make p
  zero or q one; which, is drawn so that both expectations stay. a·p + b·q does not change, and one
  of the two is decided.
- The documents of a source are dealt by hash into blocks of about ``block``. In a block the one
  that is left meets the next, one after another (an ``aggregate`` over an array of bounded length).
- Each block leaves one undecided document. These are dealt into blocks again, until one is left in
  the source, which is rounded to the nearer side. So a source's words differ from its target by less
  than one document, and log_block(documents) rounds are needed, each over 1/block of the rows.

DataFrame functions only. Rows of equal document, size and source are counted first and are one item
with several copies, so a repeated row is no hot key. Draws come from hashes of the document and
``seed``: reruns agree, whatever the partitioning. Texts are never shuffled.

Defined results. Null text: size 0. Null sources are a source of their own, the last in order. A
document of size 0 takes 0. Repeated rows are documents each. A null document id is an id. Empty
frames give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from warbler.llm.store import table

WORD = r"[^\x20\x09-\x0D]+"

FIELDS = ["draw", "id", "size", "rows", "sure", "more"]


def _meet() -> str:
    """The fold of a block's ``items``: ``c`` is the undecided document, ``done`` are the decided
    ones, ``d`` is the next. a1 and a0 are the words that c takes to reach 1 and gives to reach 0;
    b1 and b0 the words that d gives and takes."""
    def of(name: str, p: str) -> str:
        fields = ", ".join(f"'{f}', {name}.{f}" for f in FIELDS)
        return f"named_struct({fields}, 'p', {p})"

    def step(undecided: str, decided: str) -> str:
        return f"named_struct('c', {undecided}, 'done', concat(s.done, array({decided})))"

    up = (f"if(k.a1 <= k.b1, {step(of('d', '(k.b1 - k.a1) / d.size'), of('s.c', '1D'))},"
          f" {step(of('s.c', '(k.a0 + k.b1) / s.c.size'), of('d', '0D'))})")
    down = (f"if(k.a0 <= k.b0, {step(of('d', '(k.b1 + k.a0) / d.size'), of('s.c', '0D'))},"
            f" {step(of('s.c', '(k.a0 - k.b0) / s.c.size'), of('d', '1D'))})")
    masses = ("named_struct('a1', s.c.size * (1 - s.c.p), 'a0', s.c.size * s.c.p,"
              " 'b1', d.size * d.p, 'b0', d.size * (1 - d.p))")
    drawn = "d.draw * (least(k.a1, k.b1) + least(k.a0, k.b0)) < least(k.a0, k.b0)"
    return (f"aggregate(slice(items, 2, size(items)),"
            f" named_struct('c', items[0], 'done', filter(items, x -> false)),"
            f" (s, d) -> transform(array({masses}), k -> if({drawn}, {up}, {down}))[0])")


MEET = _meet()


def words(text: str):
    """Number of words, without an array of them."""
    marked = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WORD, "x")
    return F.length(F.translate(marked, " \t\n\x0b\x0c\r", "")).cast("long")


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, n, target`` of a table with a row per source (``source, source_size,
    n``). Sources in order of how soon they stop: with the level λ at which ``share`` of all words
    are given out, a source gets min(weight·λ, most·size). The windows are over all sources in one
    task, a row each: sources are as many as there are places that documents come from."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbers = F.array(*[F.lit(float(w)) for w in weights])
    rows = (sizes.withColumn("weight", F.element_at(
        numbers, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("stop", F.col("source_size") * most)
        .withColumn("at", F.col("stop") / F.col("weight")))
    order = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) * share - F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
             / F.sum("weight").over(onward))
    rows = rows.withColumn("level", level)
    rows = rows.withColumn("final", F.first(F.when(F.col("at") > F.col("level"), F.col("level")),
                                            ignorenulls=True).over(every))
    target = F.least(F.col("stop"), F.coalesce(F.col("weight") * F.col("final"), F.col("stop")))
    return rows.select("source", "source_size", "n", target.alias("target"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 64,
        seed: int = 11) -> DataFrame:
    """A row per item, that is per different (document, size, source): ``id, size, source, rows``
    (how many rows it is), ``source_size, target``, ``sure`` (copies of each row) and ``more`` (so
    many of its rows are taken once more)."""
    items = table(docs.select(F.col(key).alias("id"), words(text).alias("size"),
                              F.col(source).cast("string").alias("source"))
                  .groupBy("id", "size", "source").agg(F.count(F.lit(1)).alias("rows")), "mix-items")
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                        F.count(F.lit(1)).alias("n"))
    goals = table(targets(sizes, weights, share, most), "mix-targets")
    # A row per source; Spark sends it to the tasks only if it is as small as its threshold says.
    joined = items.alias("i").join(goals.alias("g"), F.col("i.source").eqNullSafe(F.col("g.source"))) \
        .select("i.*", "source_size", "target", "n")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(copies)
    extra = (copies - sure) * F.col("rows")
    start = joined.select(
        "source", "n", (F.pmod(F.xxhash64("id", "size", F.lit(seed)), F.lit(1 << 52))
                        / F.lit(float(1 << 52))).alias("draw"),
        "id", "size", "rows", sure.cast("long").alias("sure"), F.floor(extra).cast("long").alias("more"),
        (extra - F.floor(extra)).alias("p"))
    easy = (F.col("size") == 0) | (F.col("p") == 0)
    decided = [start.filter(easy).select("source", *FIELDS, F.lit(0.0).alias("p"))]
    left = start.filter(~easy)
    most_items = goals.agg(F.max("n")).first()[0] or 0
    rounds = max(1, math.ceil(math.log(max(most_items, 2), block)))
    for i in range(rounds):
        # ceil(n / block^(i+1)) blocks; the last round has one block a source.
        blocks = (F.lit(1) if i == rounds - 1 else
                  F.greatest(F.lit(1), F.ceil(F.col("n") / float(block ** (i + 1)))))
        dealt = left.withColumn("block", F.pmod(F.xxhash64("id", "size", F.lit(seed + 1 + i)), blocks))
        met = (dealt.groupBy("source", "n", "block")
               .agg(F.array_sort(F.collect_list(F.struct(*FIELDS, "p"))).alias("items"))
               .select("source", "n", F.expr(MEET).alias("met")))
        met = table(met, f"mix-round-{i}")
        decided.append(met.select("source", F.explode("met.done").alias("d")).select("source", "d.*"))
        left = met.select("source", "n", "met.c.*")
    decided.append(left.select("source", *FIELDS, F.round("p").alias("p")))
    rows = reduce(DataFrame.unionByName, decided)
    return (rows.alias("r").join(goals.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source")))
            .select("id", "size", "r.source", "rows", "source_size", "target", "sure",
                    (F.col("more") + F.col("p").cast("long")).alias("more")))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed: what is taken of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return (mix(docs).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * (F.col("sure") + (F.col("row") <= F.col("more")).cast("long")))
                    .alias("taken")))
