"""Chat logs to training text: event-sourced reconstruction, then a reversible template.

``messages`` folds a log of events into final messages. An event has a conversation, a sequence
number, the number of the message it speaks of, a kind, a role and a text:

- ``delta`` appends its text to the message (streamed output);
- ``message`` and ``edit`` replace what the message said so far;
- ``regenerate`` discards it, so that the deltas that follow say it anew (its own text starts it).

Folding is associative: a run of a message's events comes to (replaces what was before?, text).
So the log is dealt out by ranges of (conversation, message, sequence), each range is folded in one
pass over sorted rows, and only the first and last message of a range, which may go on in the
neighbouring ranges, meet again. A conversation with a third of all events spreads over as many
ranges as its size asks for.

``render`` writes each message as

    <|im_start|>role⏎text<|im_end|>⏎

Control strings inside roles and texts are escaped: a backslash becomes two, and one is put after
the first character of ``<|``, ``</s>``, ``<s>``, ``[INST]`` and ``[/INST]`` (in roles also before a
line feed), so no text can open or close a turn, and dropping one backslash of each pair gives the
text back. The loss mask is the span of an assistant's escaped text. A conversation's formatted text
is its messages' texts in order of ``position``; ``read_back`` parses it again, streaming.

Defined results. Null text or role: empty. Null conversation: a conversation of its own. Null
message or sequence numbers come first. Events that tie in conversation, message and sequence are
ordered by a hash of kind, role and text. A message takes the role of its last event. An unknown kind is a
delta. Empty frames give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from warbler.llm.store import table

REPLACES = ("message", "edit", "regenerate")
START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(?=\||/?s>)|\[(?=/?INST\])")
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*)\n(.*?)<\|im_end\|>\n", re.S)

FOLDED = "conv_id long, message long, part int, edge boolean, replaces boolean, role string, text string"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def messages(events: DataFrame, partitions: int | None = None) -> DataFrame:
    """``conv_id, message, role, text``: what each message says after all its events."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("seq").cast("long").alias("seq"),
        F.col("message").cast("long").alias("message"), F.col("kind").cast("string").alias("kind"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text.alias("text"))
    # Ties by hashes: the sampled bounds of the ranges hold no texts.
    rows = rows.withColumn("tie", F.xxhash64("kind", "role", "text"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "message", "seq", "tie")]
    dealt = (rows.repartitionByRange(partitions, *order) if partitions
             else rows.repartitionByRange(*order))
    runs = (dealt.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
            .mapInArrow(_fold, FOLDED))
    runs = table(runs, "chat-runs")
    whole = runs.filter(~F.col("edge")).select("conv_id", "message", "role", "text")
    # Two runs of a range at most: as many rows as there are tasks, whatever the log holds.
    run = F.struct("part", "replaces", "role", "text")
    last = F.array_sort(F.collect_list(run)).alias("runs")
    joined = F.aggregate("runs", F.lit(""), lambda said, r: F.when(r["replaces"], r["text"])
                         .otherwise(F.concat(said, r["text"])))
    edges = (runs.filter("edge").groupBy("conv_id", "message").agg(last)
             .select("conv_id", "message", F.element_at("runs", -1)["role"].alias("role"),
                     joined.alias("text")))
    return whole.unionByName(edges)


def _fold(batches):
    """Runs of a message's events, in order; the first and the last of a task are edges."""
    held, first, out = None, True, []

    def row(edge):
        return (*held[:3], edge, held[3], held[4], "".join(held[5]))

    for batch in batches:
        for conv, message, kind, role, text, part in zip(*(batch[c].to_pylist() for c in (
                "conv_id", "message", "kind", "role", "text", "part"))):
            if held is None or held[0] != conv or held[1] != message:
                if held is not None:
                    out.append(row(first))
                    first = False
                held = [conv, message, part, False, role, []]
            if kind in REPLACES:
                held[3], held[5] = True, [text]
            else:
                held[5].append(text)
            held[4] = role
        if out:
            yield _runs(out)
            out = []
    if held is not None:
        yield _runs([row(True)])


def _runs(rows):
    cols = list(zip(*rows))
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(cols, kinds)],
        names=["conv_id", "message", "part", "edge", "replaces", "role", "text"])


RENDERED = "conv_id long, position long, formatted string, loss_start int, loss_end int"


def render(said: DataFrame) -> DataFrame:
    """``conv_id, position, formatted, loss_start, loss_end``: a row per message. The conversation's
    text is ``formatted`` in order of ``position``; the loss span counts code points in its row and
    is empty except for assistants."""

    def run(batches):
        for batch in batches:
            out, lo, hi = [], [], []
            for role, text in zip(batch["role"].to_pylist(), batch["text"].to_pylist()):
                head = f"{START}{escape_role(role)}\n"
                body = escape(text)
                out.append(f"{head}{body}{END}\n")
                lo.append(len(head))
                hi.append(len(head) + (len(body) if role == "assistant" else 0))
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["message"], pa.array(out, pa.string()),
                 pa.array(lo, pa.int32()), pa.array(hi, pa.int32())],
                names=["conv_id", "position", "formatted", "loss_start", "loss_end"])

    return said.select("conv_id", "message", "role", "text").mapInArrow(run, RENDERED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests per conversation, from the formatted rows alone. Rows of a conversation come sorted
    to one task, which hashes them one after another and holds one message at a time: a digest of a
    whole conversation can't be split, but nothing of it is gathered."""
    return (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .mapInArrow(_digest, DIGEST))


def _digest(batches):
    held, rows = None, []

    def done():
        conv, n, turns, loss, chars, total = held
        rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

    for batch in batches:
        for conv, _, text, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held[0] != conv:
                if held is not None:
                    done()
                held = [conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0]
            at = 0
            for turn in _TURN.finditer(text):
                assert turn.start() == at, "text between turns"
                at = turn.end()
                role, said = unescape(turn[1]), unescape(turn[2])
                held[1] += 1
                held[2].update(f"{role}\n{said}\n".encode())
            assert at == len(text), "a turn that doesn't end"
            masked = unescape(text[lo:hi])
            held[3].update(masked.encode())
            held[4] += len(masked)
            held[5] += len(text)
        if rows:
            yield _digests(rows)
            rows.clear()
    if held is not None:
        done()
        yield _digests(rows)


def _digests(rows):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=names)


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log in which every row of (conv_id, turn, role, text) is said in six events: it is opened,
    a draft (the second half of the text) is streamed and regenerated, a slip is streamed, an edit
    puts the first half in its place, and the second half is streamed after it. Rows of one turn are
    messages of their own; ``message`` must number them (see ``numbered``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.length("said") / 2).cast("int")
    head = F.col("said").substr(F.lit(1), half)
    tail = F.col("said").substr(half + 1, F.length("said"))
    slip = F.concat(F.col("said").substr(1, 8), F.lit("?"))
    steps = [("message", F.lit("")), ("delta", tail), ("regenerate", F.lit("")), ("delta", slip),
             ("edit", head), ("delta", tail)]
    step = F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), F.lit(kind).alias("kind"), said.alias("text"))
        for i, (kind, said) in enumerate(steps)]))
    return (turns.withColumn("said", text).select("conv_id", "message", "role", "said", step.alias("e"))
            .select("conv_id", (F.col("message") * len(steps) + F.col("e.part")).alias("seq"), "message",
                    "e.kind", "role", "e.text"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7, formatted and read back."""
    quoted = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(
        "conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", quoted), (-7, 1, "assistant", quoted)],
                                "conv_id long, turn long, role string, text string")
    log = events_of_turns(numbered(turns.unionByName(own)))
    return read_back(table(render(messages(log)), "chat-formatted"))


def numbered(turns: DataFrame) -> DataFrame:
    """Adds ``message``: a number that orders a conversation's rows by turn, ties by a hash of role
    and text. Rows are dealt out and sorted by ranges; the number is the range's and the row's within it, so no
    conversation is gathered to count its rows. Equal rows, which may be many, are told apart by where
    they were read, so that ranges can split them."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "tie", "place")]
    return (turns.withColumns({"tie": F.xxhash64("role", "text"), "place": F.monotonically_increasing_id()})
            .repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("message", F.monotonically_increasing_id()))


_ESCAPES = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}"
                      for c in ("\\", "<|", "<s>", "</s>", "[INST]", "[/INST]"))

#: The same without a template but for its length: what it puts around a turn, and its escapes.
OP7_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum({len(START) + len(END) + 2} + length(role) + length(text) + {_ESCAPES.format("role")}
                + {_ESCAPES.format("text")} + length(role) - length(replace(role, chr(10), ''))) AS BIGINT)
         AS formatted_chars
FROM t GROUP BY conv_id
"""
