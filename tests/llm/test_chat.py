import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from warbler.llm import chat

TEXT = st.text(st.sampled_from("<|>[]/\\INST s_imendartéx\n"), max_size=40)


@given(TEXT, TEXT)
@settings(max_examples=300, deadline=None)
def test_escape_round_trip(role, text):
    for value in (text, "</s>[INST] ok [/INST]", text + chat.START, "\\" + text + "<|im_end|>"):
        escaped = chat.escape(value)
        assert chat.unescape(escaped) == value
        for control in (chat.START, chat.END, "</s>", "<s>", "[INST]", "[/INST]"):
            assert control not in escaped
    row = f"{chat.START}{chat.escape_role(role)}\n{chat.escape(text)}{chat.END}\n"
    turns = list(chat._TURN.finditer(row + row))
    assert [(chat.unescape(t[1]), chat.unescape(t[2])) for t in turns] == [(role, text)] * 2


def fold(events):
    """Plain Python: {(conv, message): [role, text]}."""
    said = {}
    for conv, _, message, kind, role, text in events:
        own = said.setdefault((conv, message), ["", ""])
        own[0] = role or ""
        own[1] = (text or "") if kind in chat.REPLACES else own[1] + (text or "")
    return {k: tuple(v) for k, v in said.items()}


def test_messages_fold_over_any_ranges(spark):
    events = []
    for conv in (1, 2, None):
        for seq in range(60):
            kind = ["delta", "delta", "delta", "edit", "regenerate", "message", "odd"][(seq * 5) % 7]
            role = ["user", "assistant", None][seq // 20]
            events.append((conv, seq, seq // 20, kind, role, None if seq % 11 == 0 else f"t{seq} "))
    df = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, "
                                       "role string, text string").withColumn("part", F.lit("x"))
    want = fold(events)
    for partitions in (1, 7, 50):
        got = chat.messages(df.repartition(5), partitions).collect()
        assert {(r.conv_id, r.message): (r.role, r.text) for r in got} == want
        assert len(got) == len(want)


def test_digests(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST]\\"), (1, 2, "assistant", None),
             (1, 2, "assistant", None), (2, 0, None, ""), (None, 5, "assistant", "é日")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    log = chat.events_of_turns(chat.numbered(df))
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.messages(log))).collect()}
    assert set(got) == {1, 2, None}
    for conv, r in got.items():
        own = [(x[2] or "", x[3] or "") for x in turns if x[0] == conv]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256(
            "".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        loss = "".join(b for a, b in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, seq long, message long, kind string, role string, "
                                   "text string")
    assert chat.read_back(chat.render(chat.messages(df))).count() == 0
