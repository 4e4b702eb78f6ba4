"""Property test: the Spark parse equals a plain Python parse of the same records."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from warbler.functions import record as R
from warbler.operators import tweets

WORD = st.text(alphabet="abcXYZ019_é", min_size=0, max_size=5)
PIECE = st.one_of(WORD, st.sampled_from(["#", "@", " ", ".", "#a", "@b", "x@y.z", "\t"]))
MESSAGE = st.lists(PIECE, max_size=8).map("".join)
USER = st.sampled_from(["bob", "a_1", "", "é", "x/"])
URL = st.sampled_from(["http://twitter.com/", "http://www.twitter.com/", "http://example.com/"])


def python_parse(value):
    """Independent reading of the record rules (ASCII word characters, as in Java regex)."""
    body = value.lstrip("\n")
    lines = body.split("\n")
    index = 3 if body.startswith("total") else 2
    message = lines[index] if index < len(lines) else None
    m = re.search(r"\nU\thttp.*twitter.com/(\w+)\n", value, re.ASCII)
    user = m.group(1) if m else "?????"
    mentions = re.findall(r"@(\w+)", value, re.ASCII)
    tags = re.findall(r"#(\w+)", value, re.ASCII)
    if message is None or "#" not in message or "@" not in message:
        return []
    return [(user, t, mt) for mt in mentions for t in tags]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.booleans(), URL, USER, MESSAGE), min_size=1, max_size=12))
def test_tweet_table_matches_python(spark, recs):
    values = [("total number:9\n" if header else "") + f"T\tt\nU\t{url}{user}\nW\t{msg}"
              for header, url, user, msg in recs]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = sorted(tuple(r) for r in tweets.tweet_table(df).collect())
    want = sorted(row for v in values for row in python_parse(v))
    assert got == want


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(MESSAGE, min_size=1, max_size=10), st.sampled_from(["a", "H1N1", "b_2"]))
def test_has_hashtag_matches_python(spark, messages, tag):
    df = spark.createDataFrame([(m,) for m in messages], "value string")
    got = [r.h for r in df.select(R.has_hashtag("value", tag).alias("h")).collect()]
    want = [re.search("#" + re.escape(tag) + r"[^\w]", m, re.ASCII) is not None for m in messages]
    assert got == want
