"""Sources and sinks."""

from warbler.sources.events import records_from_events
from warbler.sources.records import RECORD_SEPARATOR, scan_records, write_records
from warbler.sources.sinks import (
    edge_list_lines,
    format_pairs,
    write_csv,
    write_edge_list,
    write_parquet,
    write_text_pairs,
    write_tweet_table,
)
from warbler.sources.tables import EDGE_LIST_SCHEMA, TWEET_SCHEMA, read_tweet_table, scan_edge_list

__all__ = [
    "EDGE_LIST_SCHEMA", "RECORD_SEPARATOR", "TWEET_SCHEMA", "edge_list_lines", "format_pairs",
    "read_tweet_table", "records_from_events", "scan_edge_list", "scan_records", "write_csv",
    "write_edge_list", "write_parquet", "write_records", "write_text_pairs", "write_tweet_table",
]
