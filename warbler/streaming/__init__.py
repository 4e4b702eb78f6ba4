"""Streaming form of the stateless ingest."""

from warbler.streaming.ingest import stream_tweet_table

__all__ = ["stream_tweet_table"]
