"""Packing documents into windows of a fixed number of tokens: best-fit decreasing.

A document of several windows is first cut into full windows. The rests of one block of documents
are placed longest first into the open window that they fill tightest. ``Windows`` is a segment
tree whose leaves are the remaining capacities 0 to the window's size, each with a stack of open
windows; a node tells whether a leaf below it has one, so the tightest fit is the leftmost
non-empty leaf from the piece's length on, found in one walk.

Documents are packed where they are read: no shuffle. A task packs blocks of ``block_tokens`` ids,
so it holds a bounded number of ids; the windows that a block leaves less than ``settled`` full are
taken up again with the next block. At the end of a task, or where more than a quarter of a block
would be taken up again, the emptiest windows are cut to fill the gaps of the others, and the last
window is cut into lengths that are powers of two, which need no padding.

Defined results. Null text: empty, so its document is the end id alone. Repeated rows are packed
each on their own; ``doc_row`` counts the rows of a task, so that pieces of equal ``doc_id`` can be
told apart by (sequence task, doc_row). Null keys stay null. An empty frame packs to no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from warbler.llm.store import tidy
from warbler.llm.tokens import default_tokenizer, encoder

PIECES = ("key long, doc_row long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, ids binary")
#: sequence_id = task * 2**36 + number within the task
TASK_BITS = 36


class Windows:
    """Open windows by remaining capacity (0 to ``size``)."""

    def __init__(self, size: int):
        self.leaves = 1
        while self.leaves < size + 1:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, window: int, capacity: int) -> None:
        self.open[capacity].append(window)
        i = self.leaves + capacity
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int):
        """The tightest window with at least ``need`` left, and its capacity; None if none has."""
        i = self.leaves + need
        if not self.count[i]:
            while True:
                if i == 1:
                    return None
                if not i & 1 and self.count[i + 1]:
                    i += 1
                    break
                i >>= 1
            while i < self.leaves:
                i *= 2
                if not self.count[i]:
                    i += 1
        capacity = i - self.leaves
        window = self.open[capacity].pop()
        while i:
            self.count[i] -= 1
            i >>= 1
        return window, capacity


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Windows as lists of piece numbers; every length is at most ``size``. Ties keep the order in
    which the pieces came."""
    tree, windows = Windows(size), []
    for piece in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        n = int(lengths[piece])
        found = tree.take(n)
        if found is None:
            windows.append([piece])
            left = size - n
            if left:
                tree.add(len(windows) - 1, left)
        else:
            window, capacity = found
            windows[window].append(piece)
            if capacity > n:
                tree.add(window, capacity - n)
    return windows


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 1024,
         end_id: int = 0, tokenizer: str | None = None, block_tokens: int = 1 << 21,
         settled: float = 0.99) -> DataFrame:
    """A row per piece: ``key``, ``doc_row``, ``start`` (ids of the document before it),
    ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence, and ``ids``
    (little-endian unsigned 32-bit)."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                       F.spark_partition_id().alias("task"))
    return rows.mapInArrow(_packer(size, end_id, tokenizer or default_tokenizer(), block_tokens,
                                   settled), PIECES)


def _packer(size: int, end_id: int, tokenizer: str, block_tokens: int, settled: float):
    def run(batches):
        enc = encoder(tokenizer)
        out = _Task(size, settled, block_tokens // 4)
        for batch in batches:
            if not batch.num_rows:
                continue
            out.task = batch["task"][0].as_py()
            keys, at = batch["key"].to_pylist(), 0
            for ids, counts in enc.encode(batch["text"]):
                ends = np.cumsum(counts)
                for k, lo, hi in zip(keys[at:], (ends - counts).tolist(), ends.tolist()):
                    out.document(k, np.append(ids[lo:hi], enc.dtype.type(end_id)))
                    if out.pending >= block_tokens:
                        yield from out.flush(False)
                at += len(counts)
        yield from out.flush(True)
        tidy()

    return run


class _Task:
    """The pieces of one task; a piece is (key, doc_row, start, doc_tokens, ids)."""

    def __init__(self, size: int, settled: float, carried: int):
        self.size, self.settled, self.carried, self.task = size, settled, carried, 0
        self.rows = self.sequences = self.pending = 0
        self.rests: list[tuple] = []
        self.done: list[list[tuple]] = []

    def document(self, key, ids: np.ndarray) -> None:
        full = len(ids) - len(ids) % self.size
        for start in range(0, full, self.size):
            self.done.append([(key, self.rows, start, len(ids), ids[start:start + self.size])])
        if full < len(ids):
            self.rests.append((key, self.rows, full, len(ids), ids[full:]))
        self.rows += 1
        self.pending += len(ids)

    def flush(self, last: bool):
        pieces = self.rests
        windows = [[pieces[i] for i in w] for w in
                   best_fit_decreasing(np.array([len(p[4]) for p in pieces], np.int64), self.size)]
        fills = [sum(len(p[4]) for p in w) for w in windows]
        self.rests = []
        if last:
            windows = self._fill_gaps(windows, fills)
        else:
            least = self.settled * self.size
            self.rests = [p for w, n in zip(windows, fills) if n < least for p in w]
            if sum(len(p[4]) for p in self.rests) > self.carried:
                windows, self.rests = self._fill_gaps(windows, fills), []
            else:
                windows = [w for w, n in zip(windows, fills) if n >= least]
        done, self.done, self.pending = self.done + windows, [], 0
        for lo in range(0, len(done), 2000):
            yield self._rows(done[lo:lo + 2000])

    def _fill_gaps(self, windows: list[list[tuple]], fills: list[int]) -> list[list[tuple]]:
        """The emptiest windows are cut to fill the fullest; what is left at last is cut into
        powers of two."""
        order = sorted(range(len(windows)), key=lambda i: (-fills[i], i))
        windows = [list(windows[i]) for i in order]
        room = [self.size - fills[i] for i in order]
        lo, hi = 0, len(windows) - 1
        while lo < hi:
            if not room[lo]:
                lo += 1
                continue
            if not windows[hi]:
                hi -= 1
                continue
            piece = windows[hi].pop()
            n = min(room[lo], len(piece[4]))
            windows[lo].append((*piece[:4], piece[4][:n]))
            room[lo] -= n
            room[hi] += n
            if n < len(piece[4]):
                windows[hi].append((*piece[:2], piece[2] + n, piece[3], piece[4][n:]))
        out = [w for w in windows if w]
        if out and (n := sum(len(p[4]) for p in out[-1])) < self.size:
            out.extend(self._powers(out.pop(), n))
        return out

    def _powers(self, window: list[tuple], n: int) -> list[list[tuple]]:
        cut, queue = [], list(reversed(window))
        for bit in reversed(range(n.bit_length())):
            want, own = n & 1 << bit, []
            while want:
                piece = queue.pop()
                k = min(want, len(piece[4]))
                own.append((*piece[:4], piece[4][:k]))
                if k < len(piece[4]):
                    queue.append((*piece[:2], piece[2] + k, piece[3], piece[4][k:]))
                want -= k
            if own:
                cut.append(own)
        return cut

    def _rows(self, sequences: list[list[tuple]]) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in range(8)]
        for sequence in sequences:
            number, offset = (self.task << TASK_BITS) + self.sequences, 0
            for key, row, start, total, ids in sequence:
                for col, v in zip(cols, (key, row, start, len(ids), total, number, offset,
                                         ids.astype("<u4").tobytes())):
                    col.append(v)
                offset += len(ids)
            self.sequences += 1
        names = ["key", "doc_row", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, cols)],
            names=names)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 1024 tokens, end id 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs).select(
        F.col("key").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset")
