"""User lists as files that are read by name and place, whatever a list's length.

A folder holds ``data``, text files with a line ``name⇥users`` for each slice of a list, slices in order,
and ``index`` (Parquet), a row per slice: ``mention, file, offset`` (64 bits, of the users in the
file), ``length`` (bytes) and ``list_offset`` (64 bits, of the slice in the name's whole list, a prefix sum
over its slices). One value need hold a slice only, so a list may be longer than a value can be.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from warbler.sources.publish import _file_system, replace


def write_user_lists(slices: DataFrame, path: str, partitions: int | None = None) -> str:
    """Writes slices (mention, slice, usernames; see ``mention_user_slices``) as such a folder, with
    ``partitions`` files or as many as Spark sees fit. The slices of a name that holds a third of all
    users spread over many files."""
    spark = slices.sparkSession
    by = ("mention", "slice")

    def write(to: str) -> None:
        name = F.coalesce("mention", F.lit(""))
        rows = slices.select(name.alias("mention"), "slice", "usernames")
        dealt = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
        lines = (dealt.sortWithinPartitions(*by)
                 .select(F.concat_ws("\t", "mention", "usernames").alias("value")))
        lines.write.text(f"{to}/data")
        _index(spark.read.text(f"{to}/data")).write.parquet(f"{to}/index")

    return replace(spark, path, write)


def _index(lines: DataFrame) -> DataFrame:
    """The index of data files, from their lines: offsets are sums of the bytes before."""
    name = F.substring_index("value", "\t", 1)
    rows = lines.select(
        name.alias("mention"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"),
        F.octet_length("value").cast("long").alias("bytes"), F.octet_length(name).cast("long").alias("head"))
    # A file is what one task wrote, a row of it a slice.
    in_file = Window.partitionBy("file").orderBy("block", "nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("bytes") + 1).over(in_file), F.lit(0))
    placed = rows.select("mention", "file", (start + F.col("head") + 1).alias("offset"),
                         (F.col("bytes") - F.col("head") - 1).alias("length"))
    # As many rows as a name has slices: files are in order of their names.
    in_list = Window.partitionBy("mention").orderBy("file", "offset").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("list_offset", F.coalesce(F.sum(F.col("length") + 1).over(in_list), F.lit(0)))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def list_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(mention, slices, list_bytes): the bytes of each whole, comma-joined list."""
    return (read_index(spark, path).groupBy("mention")
            .agg(F.count(F.lit(1)).alias("slices"), F.max(F.col("list_offset") + F.col("length")).alias("list_bytes")))


def read_user_list(spark: SparkSession, path: str, mention: str) -> DataFrame:
    """(list_offset, usernames): one name's slices, from the files that hold some of them only."""
    own = read_index(spark, path).filter(F.col("mention") == mention)
    files = [r.file for r in own.select("file").distinct().collect()]  # as many as it has slices at most
    if not files:
        return spark.createDataFrame([], "list_offset long, usernames string")
    lines = spark.read.text([f"{path}/data/{f}" for f in files])
    users = F.expr("substring(value, instr(value, '\t') + 1)")
    mine = (lines.filter(F.substring_index("value", "\t", 1) == mention)
            .select(F.col("_metadata.file_name").alias("file"), users.alias("usernames"),
                    F.substring_index(users, ",", 1).alias("first")))
    # A row per slice of one name; users are sorted over its slices.
    order = Window.orderBy("file", "first").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum(F.octet_length("usernames").cast("long") + 1).over(order)
    return mine.select(F.coalesce(before, F.lit(0)).alias("list_offset"), "usernames")


def stream_user_list(spark: SparkSession, path: str, mention: str, start: int = 0, length: int | None = None,
                     chunk: int = 1 << 20) -> Iterator[bytes]:
    """The bytes ``start`` to ``start + length`` of one name's whole list, in pieces of ``chunk`` at most,
    read from their places: nothing before or after them is read, and one piece is held."""
    end = None if length is None else start + length
    own = read_index(spark, path).filter((F.col("mention") == mention)
                                         & (F.col("list_offset") + F.col("length") + 1 > start))
    if end is not None:
        own = own.filter(F.col("list_offset") < end)
    for row in own.orderBy("list_offset").toLocalIterator():
        if row.list_offset > start:
            yield b","  # between slices
        lo = max(0, start - row.list_offset)
        hi = row.length if end is None else min(row.length, end - row.list_offset)
        system, at = _file_system(spark, f"{path}/data/{row.file}")
        stream = system.open(at)
        try:
            stream.seek(row.offset + lo)
            while lo < hi:
                piece = bytes(stream.readNBytes(min(chunk, hi - lo)))
                if not piece:
                    raise OSError(f"{path}/data/{row.file} ends before its index")
                lo += len(piece)
                yield piece
        finally:
            stream.close()
