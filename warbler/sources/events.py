"""Raw microblog records derived from the driver's ``events`` table.

The original dump is not available, so each event becomes one three-line record
(``T``/``U``/``W`` lines). The derivation is a single projection: it scales with ``events`` and
needs no shuffle; the header count is a scalar subquery answered from Parquet metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values of the event -> record derivation.
#   hashtag by event_type: purchase -> Youtube, click -> IranElections, view -> iranians,
#                          signup -> H1N1, error -> Oklahama
#   second hashtag:        event_id % 3 = 0 -> H1N1, else iranians
#   user url prefix:       event_id % 97 = 0 -> http://example.com/   (no user can be parsed)
#                          event_id % 7 = 0  -> http://www.twitter.com/
#                          otherwise         -> http://twitter.com/
#   message by event_id % 10:
#     0 "No Post Title"                          1 "plain words"
#     2 "tag only #<tag>"                        3 "mention only @u<k>"
#     4 "hi @u<k> and @u<user_id % 13> #<tag> #<tag2>"
#     5 "mail a@u<k>.example #<tag> #<tag>"      6 "bare # and @ signs"
#     7, 8, 9 "RT @u<k>: #<tag> end"
#     of these, event_id % 11 = 3:             "RT @u<k>: #café #<tag> end"
#   k = first run of digits in props; header "total number:<event count>\n" on event_id 0.
#   event_id % 101 = 50: no message line (malformed); event_id % 103 = 7: a newline in front.
#
# Fixed values of the event -> edge line derivation, in order of event_id (repeated, reversed and
# self edges, decimal weights):
#   u<user_id>,u<k>,<(event_id % 9 + 1) / 10>, with the ends swapped where event_id is odd
# ---------------------------------------------------------------------------------------------
TAG_BY_EVENT_TYPE = [
    ("purchase", "Youtube"),
    ("click", "IranElections"),
    ("view", "iranians"),
    ("signup", "H1N1"),
    ("error", "Oklahama"),
]


def _tag(event_type):
    expr = None
    for kind, tag in TAG_BY_EVENT_TYPE:
        expr = F.when(event_type == kind, F.lit(tag)) if expr is None else expr.when(
            event_type == kind, F.lit(tag))
    return expr


def records_from_events(events: DataFrame) -> DataFrame:
    """``events`` → ``value: string``, one raw record per event."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    k = F.regexp_extract(F.col("props"), r"(\d+)", 1)
    tag = _tag(F.col("event_type"))
    tag2 = F.when(eid % 3 == 0, F.lit("H1N1")).otherwise(F.lit("iranians"))
    total = events.select(F.count(F.lit(1))).scalar()
    header = F.when(eid == 0, F.concat(F.lit("total number:"), total.cast("string"), F.lit("\n"))
                    ).otherwise(F.lit(""))
    prefix = (F.when(eid % 97 == 0, F.lit("http://example.com/"))
              .when(eid % 7 == 0, F.lit("http://www.twitter.com/"))
              .otherwise(F.lit("http://twitter.com/")))
    kind = eid % 10
    message = (
        F.when(kind == 0, F.lit("No Post Title"))
        .when(kind == 1, F.lit("plain words"))
        .when(kind == 2, F.concat(F.lit("tag only #"), tag))
        .when(kind == 3, F.concat(F.lit("mention only @u"), k))
        .when(kind == 4, F.concat(F.lit("hi @u"), k, F.lit(" and @u"), (uid % 13).cast("string"),
                                  F.lit(" #"), tag, F.lit(" #"), tag2))
        .when(kind == 5, F.concat(F.lit("mail a@u"), k, F.lit(".example #"), tag, F.lit(" #"), tag))
        .when(kind == 6, F.lit("bare # and @ signs"))
        .when(eid % 11 == 3, F.concat(F.lit("RT @u"), k, F.lit(": #caf\u00e9 #"), tag, F.lit(" end")))
        .otherwise(F.concat(F.lit("RT @u"), k, F.lit(": #"), tag, F.lit(" end")))
    )
    value = F.concat(
        F.when(eid % 103 == 7, F.lit("\n")).otherwise(F.lit("")), header,
        F.lit("T\t"), F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"), F.lit("\n"),
        F.lit("U\t"), prefix, F.lit("u"), uid.cast("string"),
        F.when(eid % 101 == 50, F.lit("")).otherwise(F.concat(F.lit("\nW\t"), message)),
    )
    return events.select(value.alias("value"))


def edges_from_events(events: DataFrame) -> DataFrame:
    """``events`` → ``src, dst, weight``, one edge line per event in order of ``event_id``."""
    eid = F.col("event_id")
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    other = F.concat(F.lit("u"), F.regexp_extract("props", r"(\d+)", 1))
    odd = eid % 2 == 1
    return events.orderBy("event_id").select(
        F.when(odd, other).otherwise(user).alias("src"), F.when(odd, user).otherwise(other).alias("dst"),
        ((eid % 9 + 1) / F.lit(10.0)).alias("weight"))
