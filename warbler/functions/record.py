"""Column expressions over one raw record (the ``value`` column of the record scan).

Every function takes and returns a ``Column`` built from ``pyspark.sql.functions`` only, so the
whole parse runs inside whole-stage codegen with no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values. Results depend on these exact strings; they are the record layout of the
# microblog dump and must not be changed.
#   user line pattern:     \nU\thttp.*twitter.com/(\w+)\n   (dots unescaped, greedy, as given)
#   mention pattern:       @(\w+)
#   hashtag pattern:       #(\w+)
#   unknown user:          ?????            (five question marks)
#   bad record marker:     W\tNo Post Title (substring anywhere in the record)
#   header record prefix:  total            (first record carries "total number:<n>")
# ---------------------------------------------------------------------------------------------
USER_PATTERN = r"\nU\thttp.*twitter.com/(\w+)\n"
MENTION_PATTERN = r"@(\w+)"
HASHTAG_PATTERN = r"#(\w+)"
UNKNOWN_USER = "?????"
BAD_MARKER = "W\tNo Post Title"
HEADER_PREFIX = "total"

# Position of the message line: third line, or fourth in the header record.
_MESSAGE_LINE = 2
_MESSAGE_LINE_WITH_HEADER = 3


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def body(value: Column | str) -> Column:
    """The record without newlines around it: three newlines between records leave one in front, and
    the last record of a file may end in one, which makes no line."""
    return F.trim(_col(value), F.lit("\n"))


def is_header(value: Column | str) -> Column:
    return body(value).startswith(HEADER_PREFIX)


def message_text(value: Column | str) -> Column:
    """The message line (``W\\t…``), or NULL when the record has too few lines (malformed)."""
    b = body(value)
    lines = F.split(b, "\n")
    index = F.when(b.startswith(HEADER_PREFIX), F.lit(_MESSAGE_LINE_WITH_HEADER)).otherwise(
        F.lit(_MESSAGE_LINE))
    return F.get(lines, index)


def is_marked(value: Column | str) -> Column:
    """Pre-filter: the message line holds both a ``#`` and an ``@`` (NULL message → false)."""
    msg = message_text(value)
    return F.coalesce(msg.contains("#") & msg.contains("@"), F.lit(False))


def username(value: Column | str) -> Column:
    found = F.regexp_extract(_col(value), USER_PATTERN, 1)
    return F.when(found == "", F.lit(UNKNOWN_USER)).otherwise(found)


def mentions(value: Column | str) -> Column:
    """All mentioned names in record order, repeats kept; scans the whole record."""
    return F.regexp_extract_all(_col(value), F.lit(MENTION_PATTERN), 1)


def hashtags(value: Column | str) -> Column:
    return F.regexp_extract_all(_col(value), F.lit(HASHTAG_PATTERN), 1)


def is_bad(value: Column | str) -> Column:
    return _col(value).contains(BAD_MARKER)


def record_type(value: Column | str) -> Column:
    return F.when(is_bad(value), F.lit("bad")).otherwise(F.lit("good"))


def _regex_literal(text: str) -> str:
    # A backslash before any non-alphanumeric character makes it literal in Java regex.
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in text)


def has_hashtag(value: Column | str, tag: str, match_at_end: bool = False) -> Column:
    """``#tag`` followed by one non-word character; a tag that ends the record does not match
    unless ``match_at_end``. The tag is matched literally."""
    tail = r"(?:[^\w]|$)" if match_at_end else r"[^\w]"
    return _col(value).rlike("#" + _regex_literal(tag) + tail)
