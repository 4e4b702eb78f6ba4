"""Token-id corpora as flat binary files.

Format of a corpus folder, all little-endian:

- ``part-NNNNN-ids.bin``: the ids of the part's documents end to end, ``uint16`` if the vocabulary
  fits, else ``uint32``;
- ``part-NNNNN-offsets.bin``: ``uint64``, where each document starts within the part's ids, and one
  more entry with their number;
- ``part-NNNNN-keys.bin``: ``int64`` key of each document; ``part-NNNNN-nulls.bin``: one byte a
  document, 1 where the key is null;
- ``index`` (Parquet): a row per part: ``part, files, n_docs, n_ids, base``. ``base`` is the number
  of ids in all parts before, a prefix sum over the parts.

Parts are ranges of the key in ascending order, so the files read in part order are the corpus in
key order, and any document is found by a memory map and one offset.

Defined results. Null text: empty, so its document is the end id alone. Null keys come first.
Rows with the same key are documents of their own, ordered by a hash of the text. An empty frame gives an index
without rows. Columns other than the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from warbler.llm.store import create, folder, table, tidy, view
from warbler.llm.tokens import default_tokenizer, encoder

INDEX = "part int, file string, width int, n_docs long, n_ids long"
READ = "key long, start long, n_tokens long, ids_crc32 long"


def write_corpus(docs: DataFrame, key: str = "doc_id", text: str = "text", end_id: int = 2,
                 tokenizer: str | None = None, partitions: int | None = None,
                 path: str | None = None) -> str:
    """Writes the corpus and returns its folder. ``partitions`` sets how many ranges of the key are
    written (default: Spark's shuffle partitions); a task holds one batch of texts at a time."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    path = path or folder(spark, "corpus")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    # Ties by a hash: the sampled bounds of the ranges hold no texts. Equal rows, which may be many,
    # are told apart by where they were read, so that ranges can split them.
    rows = rows.withColumns({"tie": F.xxhash64("text"), "turn": F.monotonically_increasing_id()})
    order = [F.col("key").asc_nulls_first(), F.col("tie"), F.col("turn")]
    parts = (rows.repartitionByRange(partitions, *order) if partitions
             else rows.repartitionByRange(*order))
    parts = parts.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    written = parts.mapInArrow(_writer(path, tokenizer, end_id), INDEX)
    index = table(written, "corpus-parts")
    # One row per part: the single task of this prefix sum reads as many rows as there were tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    index.withColumn("base", base).write.parquet(f"{path}/index")
    return path


def _writer(path: str, tokenizer: str, end_id: int):
    def write(batches):
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        part = first["part"][0].as_py()
        enc = encoder(tokenizer)
        name = f"{path}/part-{part:05d}-{uuid.uuid4().hex[:8]}"
        n_ids, counts, keys, nulls = 0, [], [], []
        with create(f"{name}-ids.bin") as out:
            for batch in itertools.chain([first], batches):
                keys.append(pc.fill_null(batch["key"], 0).to_numpy().astype("<i8"))
                nulls.append(batch["key"].is_null().to_numpy(zero_copy_only=False).astype("u1"))
                for ids, n in enc.encode(batch["text"]):
                    ids = np.insert(ids, np.cumsum(n), end_id)
                    out.write(ids.tobytes())
                    counts.append(n + 1)
                    n_ids += len(ids)
        counts = np.concatenate(counts)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        for kind, values in (("offsets", offsets), ("keys", np.concatenate(keys)),
                             ("nulls", np.concatenate(nulls))):
            with create(f"{name}-{kind}.bin") as out:
                out.write(values.tobytes())
        tidy()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]),
             pa.array([enc.dtype.itemsize], pa.int32()),
             pa.array([len(counts)], pa.int64()), pa.array([n_ids], pa.int64())],
            names=["part", "file", "width", "n_docs", "n_ids"])

    return write


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A row per document, from the files: ``key``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` (of its ids as unsigned 32-bit integers)."""
    index = spark.read.parquet(f"{path}/index")
    # A task for about each part: the index itself is too small for Spark to spread it.
    return index.repartition(max(1, index.count()), "part").mapInArrow(_read, READ)


def _read(batches):
    names = ["key", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for row in batch.to_pylist():
            ids = view(f"{row['file']}-ids.bin", f"<u{row['width']}")
            offsets = view(f"{row['file']}-offsets.bin", "<u8").astype(np.int64)
            keys = np.asarray(view(f"{row['file']}-keys.bin", "<i8"))
            nulls = np.asarray(view(f"{row['file']}-nulls.bin", "u1")).astype(bool)
            for lo in range(0, len(keys), 10_000):
                hi = min(lo + 10_000, len(keys))
                crcs = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in
                        zip(offsets[lo:hi].tolist(), offsets[lo + 1:hi + 1].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo:hi], pa.int64(), mask=nulls[lo:hi]),
                     pa.array(offsets[lo:hi] + row["base"]),
                     pa.array(offsets[lo + 1:hi + 1] - offsets[lo:hi]),
                     pa.array(crcs, pa.int64())], names=names)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` written as token-id files with end id 2, and read back from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = write_corpus(docs, end_id=2)
    return read_corpus(spark, path).withColumnRenamed("key", "doc_id")
