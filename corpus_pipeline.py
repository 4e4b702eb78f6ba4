"""From raw documents to packed training windows: five stages, each one operator over all that the
stage before kept. ``run`` writes every stage to the shared folder and reads it back; what a stage
wrote goes once the next has read it.

Every stage but the last returns the columns of ``documents``; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from warbler.llm import jaccard, mixing, packing, suffix, toxicity
from warbler.llm.store import discard, fresh, passing, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold of their language. Each text is scored once;
    what the stage leaves in the shared folder are the ids, languages and text hashes of those that
    go, and no texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key, mark, lang, score, limit = fresh(docs, "_id", "_mark", "_lang", "_score", "_limit")
    texts = docs.select("doc_id", "text", "lang", F.xxhash64("text").alias(mark))
    with passing(spark) as keep:
        scored = toxicity.classify(texts, labels, score_name=score, threshold_name=limit,
                                   keep=("doc_id", "lang", mark))
        toxic = keep(table(scored.filter(~(F.col(score) < F.col(limit))).select(
            F.col("doc_id").alias(key), F.col("lang").cast("string").alias(lang), mark), "toxicity-found"))
    # Rows of one id, language and text have one score and one threshold.
    on = (F.col("doc_id").eqNullSafe(F.col(key)) & F.col("lang").cast("string").eqNullSafe(F.col(lang))
          & (F.xxhash64("text") == F.col(mark)))
    return docs.join(toxic, on, "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return jaccard.keep_one(docs, words=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes that a smaller id has. Bytes left of a cut character
    are dropped; documents that nothing is left of go."""
    names = fresh(docs, "_text", "_n_bytes", "_n_removed", "_n_spans")
    said, removed = F.col(names[0]), F.col(names[2])
    kept = suffix.kept_texts(docs, suffix.removed(docs), as_text=True, names=tuple(names))
    left = kept.filter((removed == 0) | (F.length(said) > 0))
    return left.select(*[
        F.when(removed > 0, said).otherwise(F.col(c)).alias(c) if c == "text" else
        F.when(removed > 0, F.length(said).cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else
        F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    key, words, source, rows, sure, more, size, nth, copies, copy = fresh(
        docs, "_id", "_words", "_source", "_rows", "_sure", "_more", "_size", "_nth", "_copies", "_copy")
    with passing(spark) as keep:
        items = keep(table(mixing.mix(docs).select(*[F.col(c).alias(n) for c, n in (
            ("id", key), ("size", words), ("source", source), ("rows", rows), ("sure", sure), ("more", more))]),
            "mix-taken"))
    on = (F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(size) == F.col(words))
          & F.col("source").cast("string").eqNullSafe(F.col(source)))
    joined = (docs.withColumn(size, mixing.words("text"))
              .join(items.filter(F.col(sure) + F.col(more) > 0), on))
    # Repeated rows are told apart by their number; only they are brought together again.
    number = F.row_number().over(Window.partitionBy(key, words, source).orderBy(size))
    numbered = (joined.filter(F.col(rows) == 1).withColumn(nth, F.lit(1))
                .unionByName(joined.filter(F.col(rows) > 1).withColumn(nth, number)))
    times = F.col(sure) + (F.col(nth) <= F.col(more)).cast("long")
    return (numbered.withColumn(copies, times).filter(F.col(copies) > 0)
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
            .select(*docs.columns))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents packed into windows of 1024 tokens, a row per piece."""
    return packing.pack(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Training, random rounding and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the pieces of the packed windows."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with passing(spark) as keep:
            docs = keep(table(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if before is not None:
            discard(before)
        before = docs
    return docs
