"""Writers. All are distributed; a single output file is made only from a small, aggregated
result (``single_file=True``). An overwrite is staged: the earlier output stays until the new one is
whole (see ``publish``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from warbler.sources.publish import replace

#: Bits of the bloom filters follow from this number of different values a row group.
BLOOM_VALUES = 200_000


def _written(df: DataFrame, path: str, mode: str, save: Callable[[DataFrameWriter, str], None]) -> str:
    if mode == "overwrite":
        return replace(df.sparkSession, path, lambda staging: save(df.write, staging))
    save(df.write.mode(mode), path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    return _written(df, path, mode, lambda w, to: w.parquet(to))


def write_tweet_table(tweets: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Tweet table as Parquet, sorted by hashtag inside each file so that a topic filter skips
    row groups by their min/max statistics; bloom filters on hashtag and mention skip those whose
    range holds a value that the row group does not. No shuffle: a hot hashtag stays spread over
    tasks."""
    def save(writer: DataFrameWriter, to: str) -> None:
        for column in ("hashtag", "mention"):
            writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                      .option(f"parquet.bloom.filter.expected.ndv#{column}", str(BLOOM_VALUES)))
        writer.parquet(to)

    return _written(tweets.sortWithinPartitions("hashtag"), path, mode, save)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV without a header, one part file per task. ``single_file`` sends every row through one
    task and is meant only for results whose size is bounded (a handful of rows)."""
    out = df.coalesce(1) if single_file else df
    return _written(out, path, mode, lambda w, to: w.option("header", "false").csv(to))


def format_pairs(counts: DataFrame, key: str = "record_type", count: str = "count") -> DataFrame:
    """``(key,count)`` text lines."""
    return counts.select(F.format_string("(%s,%d)", F.col(key), F.col(count)).alias("value"))


def write_text_pairs(counts: DataFrame, path: str, key: str = "record_type", count: str = "count",
                     single_file: bool = False) -> str:
    """``(key,count)`` lines as text; fails if the path exists, like the original report."""
    out = format_pairs(counts, key, count)
    if single_file:
        out = out.coalesce(1)
    out.write.mode("errorifexists").text(path)
    return path


def edge_list_lines(edges: DataFrame) -> DataFrame:
    """One ``src,dst,weight`` line per edge (weight printed as it is typed)."""
    return edges.select(F.concat_ws(",", F.col("src"), F.col("dst"),
                                    F.col("weight").cast("string")).alias("value"))


def write_edge_list(edges: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Edge list readable by ``scan_edge_list``; written by all tasks in parallel. Quotes in a name
    are doubled and blanks around it stay, as the reader takes them."""
    return _written(
        edges.select("src", "dst", "weight"), path, mode,
        lambda w, to: w.option("header", "false").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(to))
