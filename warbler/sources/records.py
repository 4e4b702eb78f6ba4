"""Blank-line-delimited record files: scan and write.

A record is everything between two ``\\n\\n`` separators. Spark's text source splits large files
across tasks and hands each record to exactly one task, so the scan is parallel at any size; a
single record must fit in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RECORD_SEPARATOR = "\n\n"


def scan_records(spark: SparkSession, path: str, record_sep: str = RECORD_SEPARATOR) -> DataFrame:
    """Raw records as ``value: string`` (byte offsets are not kept)."""
    return spark.read.option("lineSep", record_sep).text(path)


def write_records(records: DataFrame, path: str, record_sep: str = RECORD_SEPARATOR,
                  mode: str = "overwrite") -> str:
    """Write a ``value`` column as a record file (every record followed by the separator)."""
    records.select("value").write.mode(mode).option("lineSep", record_sep).text(path)
    return path
