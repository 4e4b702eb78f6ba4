"""Scalar column functions over raw records."""

from warbler.functions.record import (
    BAD_MARKER,
    HASHTAG_PATTERN,
    HEADER_PREFIX,
    MENTION_PATTERN,
    UNKNOWN_USER,
    USER_PATTERN,
    body,
    has_hashtag,
    hashtags,
    is_bad,
    is_header,
    is_marked,
    mentions,
    message_text,
    record_type,
    username,
)

__all__ = [
    "BAD_MARKER", "HASHTAG_PATTERN", "HEADER_PREFIX", "MENTION_PATTERN", "UNKNOWN_USER",
    "USER_PATTERN", "body", "has_hashtag", "hashtags", "is_bad", "is_header", "is_marked",
    "mentions", "message_text", "record_type", "username",
]
