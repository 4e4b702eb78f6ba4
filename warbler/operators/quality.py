"""Bad-record report: a record is bad when it contains ``W\\tNo Post Title`` anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warbler.functions import record as R


def bad_records(records: DataFrame, value: str = "value") -> DataFrame:
    return records.filter(R.is_bad(F.col(value)))


def bad_record_total(records: DataFrame, value: str = "value") -> DataFrame:
    """One row ``bad_records``; 0 on empty input (partial counts per task, one final sum)."""
    return records.agg(F.count_if(R.is_bad(F.col(value))).alias("bad_records"))


def record_type_counts(records: DataFrame, value: str = "value") -> DataFrame:
    """(record_type, count) with record_type in {good, bad}; map-side combined."""
    return (records.select(R.record_type(F.col(value)).alias("record_type"))
            .groupBy("record_type").agg(F.count(F.lit(1)).alias("count")))
