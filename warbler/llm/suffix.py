"""Removing repeated passages: suffix arrays per shard, merged across shards.

A byte goes if a string of ``length`` bytes that covers it also starts in a document with a smaller
id. All strings ("windows") are judged on the input.

1. ``Blocks``: texts are packed into blocks of about 2 MB where they are read; a long text is cut
   into pieces that overlap by length − 1 bytes, so every window lies in exactly one piece.
2. Fingerprints: a window's fingerprint is the smallest hash of the 25-byte strings in it, so equal
   windows have equal fingerprints, and neighbours mostly share one. Each block sends its different
   fingerprints (32 bits of them) to hash buckets, and is answered which of them another block has
   too, in a file of its own in the shared folder. What no other document shares can't repeat, and is
   left out from here on; a chance meeting of 32 bits only leaves a little more in.
3. Shards: each block builds the suffix array of the stretches that are left, by Larsson-Sadakane
   refinement (ranks of 8, 16, 32, then ``length`` bytes; settled groups are not sorted again), and
   their common prefixes by Kasai's recurrence. Runs of common prefixes of ``length`` or more are
   equal windows; the smallest id of a run decides within the block.
4. Merging: windows that their own block has not decided, and that other blocks may have, go to the
   bucket of their fingerprint, as stretches that share one. Equal stretches are merged first; the
   windows of the different ones are sorted by hash, block after block found in what was merged
   before by binary search, and compared byte by byte. Blocks are merged in rounds of
   ``fan_in`` blocks, so a passage that every block holds comes to a merging task ``fan_in`` times at
   most, not once per block.
5. The intervals removed are gathered per document and applied to its text.

Every count that sizes a task (blocks per round, fingerprints and stretches per bucket) follows from
the input, so memory in a task is bounded whatever the table holds.

Defined results. Null text: empty. A null id counts as larger than all others. Rows of one id are
judged each, and never against one another. Texts shorter than ``length`` bytes are kept. Empty
frames give no rows. ``dedup`` uses only the id and the text, whatever other columns there are;
``kept_texts`` returns all of them.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from warbler.llm.store import create, exists, folder, fresh, passing, table, tidy, view

GRAM = 25
BLOCK_BYTES = 2 << 20
PIECE_BYTES = 1 << 20
NONE = (1 << 63) - 1  # the id of rows without one

BLOCKS = "block long, n long, docs binary, data binary"
PRINTS = "bucket int, block long, prints binary"
SHARED = "block long, prints binary"
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


# -- numpy ---------------------------------------------------------------------------------------

def _powers(n: int):
    """Powers of the base and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + PIECE_BYTES + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            np.multiply.accumulate(p, out=p)
            _POWERS[name] = p
    return _POWERS["up"][:n], _POWERS["down"][:n]


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte strings (64 bits, well mixed)."""
    n = len(data) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.multiply(data.astype(np.uint64) + np.uint64(1), up[:-1], out=sums[1:])
    np.add.accumulate(sums, out=sums)
    h = (sums[k:] - sums[:n]) * down[:n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def fingerprints(data: np.ndarray, length: int) -> np.ndarray:
    """Each window's smallest hash of a GRAM-byte string in it."""
    h = rolling(data, GRAM)
    want, have = length - GRAM + 1, 1
    while have < want:
        step = min(have, want - have)
        h = np.minimum(h[:len(h) - step], h[step:])
        have += step
    return h


def suffix_array(text: np.ndarray, n: int, depth: int) -> np.ndarray:
    """The first n positions of ``text`` (which goes on for ``depth`` bytes at least) in order of
    their first ``depth`` bytes, ties in order of position. 8 <= depth."""
    padded = np.ascontiguousarray(text)
    keys = np.ndarray((n,), ">u8", padded, strides=(1,)).astype(np.uint64)
    sa = np.argsort(keys).astype(np.int32)
    new = np.empty(n, bool)
    new[:1] = True
    sorted_keys = keys[sa]
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    del keys, sorted_keys
    rank = np.empty(n, np.int32)
    slots = np.arange(n, dtype=np.int32)
    rank[sa] = np.maximum.accumulate(np.where(new, slots, 0))
    known = 8
    while True:
        open_ = ~(new & np.r_[new[1:], True])  # members of groups of more than one
        where = np.flatnonzero(open_)
        if not len(where):
            return sa
        pos = sa[where]
        if known < depth:
            step = min(known, depth - known)
            ahead = pos.astype(np.int64) + step
            later = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        else:
            later = pos  # the last round: ties in order of position
        key = rank[pos].astype(np.int64) * (n + 1) + later
        order = np.argsort(key)
        key = key[order]
        pos = pos[order]
        sa[where] = pos
        if known == depth:
            return sa
        first = np.r_[True, key[1:] != key[:-1]]
        new[where] = first
        rank[pos] = np.maximum.accumulate(np.where(first, where, 0)).astype(np.int32)
        known += step


def common_prefixes(text: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """For each place in ``sa``: the common prefix with the place before, ``depth`` at most.
    Kasai's recurrence along neighbours: if the suffixes at i and j = before(i) start alike, those at
    i + 1 and j + 1 share one byte less. Where before(i + 1) is not j + 1, the chain ends, and only
    there bytes are compared."""
    n = len(sa)
    before = np.empty(n, np.int64)
    before[sa[0]] = -1
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    alike = np.zeros(n, bool)
    has = before >= 0
    alike[has] = text[here[has]] == text[before[has]]
    end = np.ones(n, bool)
    end[:-1] = before[1:] != before[:-1] + 1
    ends = np.flatnonzero(end & alike)
    share = np.zeros(n, np.int64)
    left, k = ends, 0
    while len(left) and k < depth:
        left = left[text[left + k] == text[before[left] + k]]
        k += 1
        share[left] = k
    stop = np.where(end | ~alike, here, n)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    got = np.minimum(stop - here + share[stop], depth)
    return got[sa]


def runs(flags: np.ndarray):
    """Starts and ends of the runs of True."""
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edges[::2], edges[1::2]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each stretch, end to end."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(starts - (ends - sizes), sizes)


# -- blocks --------------------------------------------------------------------------------------

def _pack(length: int, block_bytes: int, piece_bytes: int):
    def run(batches):
        docs, data, size, count = [], [], 0, 0

        def block():
            return pa.RecordBatch.from_arrays(
                [pa.array([(task << 36) + count]), pa.array([size], pa.int64()),
                 pa.array([np.array(docs, "<i8").tobytes()], pa.binary()),
                 pa.array([b"".join(data)], pa.binary())], names=["block", "n", "docs", "data"])

        for batch in batches:
            if not batch.num_rows:
                continue
            task = batch["task"][0].as_py()
            for key, mark, text in zip(*(batch[c].to_pylist() for c in ("id", "mark", "text"))):
                if len(text) < length:
                    continue
                for lo in range(0, len(text) - length + 1, piece_bytes):
                    piece = text[lo:lo + piece_bytes + length - 1]
                    docs.append((key, mark, lo, len(piece)))
                    data.append(piece)
                    size += len(piece)
                    if size >= block_bytes:
                        yield block()
                        docs, data, size, count = [], [], 0, count + 1
        if docs:
            yield block()

    return run


class _Block:
    """A block's bytes and, for each window that lies in one piece, its fingerprint."""

    def __init__(self, docs: bytes, data: bytes, length: int):
        self.docs = np.frombuffer(docs, "<i8").reshape(-1, 4)
        self.data = np.frombuffer(data, np.uint8)
        sizes = self.docs[:, 3]
        self.starts = np.cumsum(sizes) - sizes
        prints = fingerprints(self.data, length)
        ok = np.zeros(len(prints), bool)
        ok[spread(self.starts, sizes - length + 1)] = True
        first = np.empty(len(prints), bool)
        first[:1] = True
        np.not_equal(prints[1:], prints[:-1], out=first[1:])
        first[self.starts] = True
        #: stretches of windows of one piece that share a fingerprint
        self.lo = np.flatnonzero(first & ok)
        ends = np.r_[self.lo[1:], len(prints)]
        self.piece = np.searchsorted(self.starts, self.lo, "right") - 1
        self.hi = np.minimum(ends, (self.starts + sizes - length + 1)[self.piece])
        self.prints = prints[self.lo]


def _bucket(prints: np.ndarray, buckets: int) -> np.ndarray:
    return (prints % np.uint64(buckets)).astype(np.int32)


def _by_bucket(bucket: np.ndarray):
    """Order by bucket, and (bucket, from, to) of each in that order."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(b) else np.empty(0, np.int64)
    return order, list(zip(b[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(b)]))


def _short(prints: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32 bits of each fingerprint."""
    return ((prints % np.uint64(buckets)) << np.uint64(32)) | (prints >> np.uint64(32))


def _print_rows(length: int, buckets: int):
    def run(batches):
        for batch in batches:
            for block, docs, data in zip(batch["block"].to_pylist(), batch["docs"], batch["data"]):
                b = _Block(docs.as_py(), data.as_py(), length)
                short = np.unique(_short(b.prints, buckets))
                _, parts = _by_bucket(short >> np.uint64(32))
                prints = short.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in parts], pa.int32()),
                     pa.array([block] * len(parts), pa.int64()),
                     pa.array([prints[lo:hi].tobytes() for _, lo, hi in parts], pa.binary())],
                    names=["bucket", "block", "prints"])

    return run


def _share_rows(batches):
    """Per block, the fingerprints of this task's buckets that other blocks have too."""
    blocks, prints = [], []
    for batch in batches:
        blocks += batch["block"].to_pylist()
        prints += [np.frombuffer(x.as_py(), np.uint32) | np.uint64(bucket << 32)
                   for bucket, x in zip(batch["bucket"].to_pylist(), batch["prints"])]
    if not blocks:
        return
    who = np.repeat(np.arange(len(blocks), dtype=np.int32), [len(p) for p in prints])
    prints = np.concatenate(prints)
    order = np.argsort(prints)
    prints, who = prints[order], who[order]
    same = prints[1:] == prints[:-1]
    both = np.r_[same, False] | np.r_[False, same]  # a block names each of its prints once
    prints, who = prints[both], who[both]
    _, parts = _by_bucket(who)
    order = np.argsort(who, kind="stable")
    prints = prints[order]
    for lo in range(0, len(parts), 1000):
        yield pa.RecordBatch.from_arrays(
            [pa.array([blocks[w] for w, _, _ in parts[lo:lo + 1000]], pa.int64()),
             pa.array([prints[a:z].tobytes() for _, a, z in parts[lo:lo + 1000]], pa.binary())],
            names=["block", "prints"])


def _answer(path: str):
    """Writes each block's shared prints to a file. A task holds those of its blocks."""

    def run(batches):
        own: dict[int, list[bytes]] = {}
        for batch in batches:
            for block, prints in zip(batch["block"].to_pylist(), batch["prints"].to_pylist()):
                own.setdefault(block, []).append(prints)
        for block, parts in own.items():
            with create(f"{path}/{block}") as out:
                for x in parts:
                    out.write(x)
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64())], names=["block"])

    return run


def _cut_rows(ids, marks, lo, hi, length):
    """Windows lo to hi - 1 of a document removed: bytes lo to hi + length - 2."""
    return [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(lo, pa.int64()),
            pa.array(hi + (length - 1), pa.int64())]


def _local(length: int, tasks: int, buckets: int, path: str):
    """What each block removes by itself, and what is to be merged. Rows of both kinds in one
    table; cuts have no ``docs``."""

    def run(batches):
        for batch in batches:
            for block, docs, data in zip(batch["block"].to_pylist(), batch["docs"], batch["data"]):
                found = of_block(block, _Block(docs.as_py(), data.as_py(), length))
                yield from found.combine_chunks().to_batches()

    def of_block(block, b):
        uri = f"{path}/{block}"
        others = np.sort(view(uri, np.uint64)) if exists(uri) else np.empty(0, np.uint64)
        short = _short(b.prints, tasks)
        at = np.minimum(np.searchsorted(others, short), max(0, len(others) - 1))
        abroad = others[at] == short if len(others) else np.zeros(len(short), bool)
        ids = b.docs[b.piece, 0]
        # prints of more than one document of this block
        order = np.argsort(b.prints, kind="stable")
        group = np.cumsum(np.r_[False, np.diff(b.prints[order]) != 0]) if len(order) else order
        heads = np.flatnonzero(np.r_[True, np.diff(group) != 0]) if len(order) else order
        home = np.zeros(len(b.prints), bool)
        if len(order):
            low = np.minimum.reduceat(ids[order], heads)
            high = np.maximum.reduceat(ids[order], heads)
            home[order] = (low != high)[group]
        keep = abroad | home
        if not keep.any():
            return _both([], [], [], [], [])
        lo, hi, abroad, ids = b.lo[keep], b.hi[keep], abroad[keep], ids[keep]
        piece, prints = b.piece[keep], b.prints[keep]
        # Stretches of bytes that these windows cover, end to end.
        joined = np.r_[False, (lo[1:] < hi[:-1] + length - 1) & (piece[1:] == piece[:-1])]
        part = np.cumsum(~joined) - 1
        part_lo = lo[~joined]
        part_hi = np.r_[hi[:-1][~joined[1:]], hi[-1]] + length - 1
        shift = np.cumsum(part_hi - part_lo) - (part_hi - part_lo) - part_lo
        text = b.data[spread(part_lo, part_hi - part_lo)]
        n = len(text)
        text = np.concatenate([text, np.zeros(length + 8, np.uint8)])
        sizes = hi - lo
        windows = spread(lo + shift[part], sizes)  # in text
        owner = np.full(n, -1, np.int32)
        owner[windows] = np.repeat(np.arange(len(lo), dtype=np.int32), sizes)
        sa = suffix_array(text, n, length)
        equal = common_prefixes(text, sa, length) >= length
        heads = np.flatnonzero(~equal)
        key = np.where(owner[sa] >= 0, ids[owner[sa]], NONE)
        least = np.empty(n, np.int64)
        least[sa] = np.repeat(np.minimum.reduceat(key, heads), np.diff(np.r_[heads, n]))
        gone = np.zeros(n, bool)
        gone[windows] = least[windows] < ids[owner[windows]]
        del sa, equal, key, least
        # Cuts: runs of removed windows of one stretch of bytes, in the document's places.
        step = np.zeros(n, bool)
        step[part_lo + shift] = True
        c_lo, c_hi = _split_runs(gone, step)
        own = owner[c_lo]
        back = b.docs[piece[own], 2] - b.starts[piece[own]] - shift[part[own]]
        cuts = [b.docs[piece[own], 0], b.docs[piece[own], 1], c_lo + back, c_hi + back]
        # Undecided windows that other blocks may have: runs of one stretch.
        ask = np.zeros(n, bool)
        ask[windows] = abroad[owner[windows]] & ~gone[windows]
        step[:] = False
        step[lo + shift[part]] = True
        a_lo, a_hi = _split_runs(ask, step)
        own = owner[a_lo]
        back = b.docs[piece[own], 2] - b.starts[piece[own]] - shift[part[own]]
        order, parts = _by_bucket(_bucket(prints[own], buckets))
        docs = np.stack([b.docs[piece[own], 0], b.docs[piece[own], 1], a_lo + back, a_hi - a_lo],
                        axis=1)[order] if len(own) else np.empty((0, 4), np.int64)
        a_lo = a_lo[order]
        found = []
        for bucket, x, y in parts:
            raw = text[spread(a_lo[x:y], docs[x:y, 3] + length - 1)]
            found.append((bucket, block, *_squeeze(docs[x:y], raw.tobytes()), len(raw)))
        return _both(*(list(c) for c in zip(*found)) if found else ([],) * 5, cuts=cuts,
                     length=length, near=block % buckets)

    return run


def _squeeze(docs: np.ndarray, data: bytes) -> tuple[bytes, bytes]:
    """Stretches as they travel: the columns of ``docs`` as differences, one after another."""
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    steps = np.diff(docs, axis=0, prepend=0) if len(docs) else docs
    return press.compress(steps.T.astype("<i8").tobytes()), press.compress(data)


def _open(docs: bytes, data: bytes) -> tuple[np.ndarray, bytes]:
    import zstandard

    unpress = zstandard.ZstdDecompressor()
    steps = np.frombuffer(unpress.decompress(docs), "<i8").reshape(4, -1).T
    return np.cumsum(steps, axis=0), unpress.decompress(data)


def _split_runs(flags: np.ndarray, step: np.ndarray):
    """Runs of True that also end where ``step`` begins a new stretch."""
    n = len(flags)
    start = flags & np.r_[True, ~flags[:-1] | step[1:]] if n else flags
    end = flags & np.r_[~flags[1:] | step[1:], True] if n else flags
    return np.flatnonzero(start), np.flatnonzero(end) + 1


#: Undecided stretches of a bucket, ``docs`` with (id, mark, start, windows) of each, both compressed
#: (see ``_squeeze``); or a cut.
BOTH = "bucket int, block long, docs binary, data binary, size long, id long, mark long, lo long, hi long"


def _both(bucket, block, docs, data, size, cuts=None, length=0, near=0) -> pa.Table:
    """Stretches to merge, then cuts (which go along with the bucket ``near``), in one table."""
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    names = ["bucket", "block", "docs", "data", "size", "id", "mark", "lo", "hi"]
    found = [pa.array(x, k) for x, k in zip((bucket, block, docs, data, size), kinds)]
    cut = _cut_rows(*cuts, length) if cuts else [pa.array([], pa.int64())] * 4
    n, m = len(found[0]), len(cut[0])
    return pa.Table.from_arrays(
        [pa.concat_arrays([found[0], pa.array(np.full(m, near, np.int32))]),
         *(pa.concat_arrays([f, pa.nulls(m, f.type)]) for f in found[1:]),
         *(pa.concat_arrays([pa.nulls(n, pa.int64()), c]) for c in cut)], names=names)


# -- merging -------------------------------------------------------------------------------------

def _merge_bucket(rows, length: int) -> pa.Table:
    """All stretches of one bucket: removes windows that a smaller id has, and passes the others on."""
    opened = [_open(r[2], r[3]) for r in rows]
    docs = np.concatenate([d for d, _ in opened])
    data = np.frombuffer(b"".join(x for _, x in opened), np.uint8)
    blocks = np.repeat(np.arange(len(rows)), [len(d) for d, _ in opened])
    del opened
    sizes = docs[:, 3] + length - 1
    starts = np.cumsum(sizes) - sizes
    # Equal stretches first: one stands for all, with the smallest id.
    raw = data.tobytes()
    number: dict[bytes, int] = {}
    kind = np.array([number.setdefault(raw[a:a + n], len(number))
                     for a, n in zip(starts.tolist(), sizes.tolist())])
    n_kinds = len(number)
    number.clear()
    first = np.full(n_kinds, len(docs))
    np.minimum.at(first, kind, np.arange(len(docs)))
    low = np.full(n_kinds, NONE)
    np.minimum.at(low, kind, docs[:, 0])
    # The windows of the different stretches.
    counts = docs[first, 3]
    places = spread(starts[first], counts)
    of_kind = np.repeat(np.arange(n_kinds), counts)
    hashes = rolling(data, length)[places]
    least = _least_ids(data, hashes, places, low[of_kind], blocks[first][of_kind], length)
    # Back to all stretches, window by window.
    kind_at = np.cumsum(counts) - counts
    every = spread(kind_at[kind], docs[:, 3])
    who = np.repeat(np.arange(len(docs)), docs[:, 3])
    gone = least[every] < docs[who, 0]
    step = np.zeros(len(gone), bool)
    offset = np.cumsum(docs[:, 3]) - docs[:, 3]
    step[offset] = True
    lo, hi = _split_runs(gone, step)
    own = who[lo]
    back = docs[own, 2] - offset[own]
    cuts = [docs[own, 0], docs[own, 1], lo + back, hi + back]
    lo, hi = _split_runs(~gone, step)
    own = who[lo]
    kept = np.stack([docs[own, 0], docs[own, 1], lo + docs[own, 2] - offset[own], hi - lo], axis=1)
    left = data[spread(starts[own] + lo - offset[own], hi - lo + length - 1)].tobytes()
    kept, packed = _squeeze(kept, left)
    return _both([rows[0][0]], [rows[0][1]], [kept], [packed], [len(left)],
                 cuts=cuts, length=length, near=rows[0][0])


def _least_ids(data, hashes, places, ids, blocks, length: int) -> np.ndarray:
    """For each window the smallest id of the equal ones. Block after block is found by binary
    search in the sorted windows merged so far; halves are merged pairwise."""
    lists = []
    cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(blocks) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(blocks)]):
        order = np.argsort(hashes[lo:hi], kind="stable") + lo
        lists.append(order)
    while len(lists) > 1:
        merged = []
        for i in range(0, len(lists) - 1, 2):
            a, b = lists[i], lists[i + 1]
            out = np.empty(len(a) + len(b), np.int64)
            at = np.searchsorted(hashes[a], hashes[b], "right") + np.arange(len(b))
            mask = np.zeros(len(out), bool)
            mask[at] = True
            out[mask], out[~mask] = b, a
            merged.append(out)
        lists = merged + lists[len(lists) & ~1:]
    order = lists[0] if lists else np.empty(0, np.int64)
    h = hashes[order]
    heads = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else order
    group = np.repeat(np.arange(len(heads)), np.diff(np.r_[heads, len(h)]))
    # Byte by byte: a hash met by different windows is taken apart.
    a, b = places[order], places[order[heads]][group]
    check = np.flatnonzero(a != b)
    differ = np.zeros(len(order), bool)
    for k in range(length):
        differ[check] |= data[a[check] + k] != data[b[check] + k]
    least = np.empty(len(order), np.int64)
    if len(order):
        least[order] = np.minimum.reduceat(ids[order], heads)[group]
    for g in np.unique(group[differ]).tolist():
        own: dict[bytes, list[int]] = {}
        for w in order[group == g].tolist():
            own.setdefault(data[places[w]:places[w] + length].tobytes(), []).append(w)
        for members in own.values():
            least[members] = ids[members].min()
    return least


# -- the operator --------------------------------------------------------------------------------

def _id(key: str):
    return F.coalesce(F.col(key).cast("long"), F.lit(NONE))


def _raw(text: str):
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def text_mark(text: str):
    """A hash of the text, which tells texts of one id apart."""
    return F.xxhash64(_raw(text))


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 50,
            block_bytes: int = BLOCK_BYTES, piece_bytes: int = PIECE_BYTES, fan_in: int = 512,
            bucket_prints: int = 1 << 20, bucket_bytes: int = 4 << 20) -> DataFrame:
    """``id, mark, lo, hi``: bytes lo to hi - 1 of a text go (intervals may overlap). ``mark`` tells
    texts of one id apart (see ``text_mark``)."""
    if length < GRAM + 7:
        raise ValueError(f"length must be at least {GRAM + 7}")
    rows = docs.select(_id(key).alias("id"), text_mark(text).alias("mark"), _raw(text).alias("text"),
                       F.spark_partition_id().alias("task"))
    with passing(docs.sparkSession) as keep:
        blocks = table(rows.mapInArrow(_pack(length, block_bytes, piece_bytes), BLOCKS), "suffix-blocks")
        n_blocks, n_bytes = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        # About 2 of 27 windows start a new fingerprint.
        tasks = max(1, -(-n_bytes * 2 // 27 // bucket_prints))
        path = folder(docs.sparkSession, "suffix-shared")
        prints = blocks.mapInArrow(_print_rows(length, tasks), PRINTS)
        shared = prints.repartition(tasks, "bucket").mapInArrow(_share_rows, SHARED)
        table(shared.repartition(max(1, -(-n_blocks // 16)), "block")
              .mapInArrow(_answer(path), "block long"), "suffix-answered")
        buckets = max(1, -(-n_bytes // bucket_bytes))
        both = blocks.mapInArrow(_local(length, tasks, buckets, path), BOTH)
        cuts, left, level = [], max(2, n_blocks), 0
        while left > 1:
            left = -(-left // fan_in)
            # Blocks of a round: the teams of the round before, by hash.
            team = F.pmod(F.xxhash64("block", F.lit(level)), F.lit(left))
            both = table(both.withColumn("team", team).groupBy("bucket", "team")
                         .applyInArrow(_merge_team(length, left > 1), BOTH), f"suffix-merge-{level}")
            cuts.append(both.filter("docs is null").select("id", "mark", "lo", "hi"))
            both, level = both.filter("docs is not null"), level + 1
        return keep(table(reduce(DataFrame.unionByName, cuts), "suffix-cuts"))


def _merge_team(length: int, more: bool):
    """Merges a bucket's stretches of a team of blocks, and passes cuts on. ``more``: what is left
    stands for the team in the next round."""

    def run(key, rows):
        is_cut = rows["docs"].is_null()
        cuts, found = rows.filter(is_cut), rows.filter(pc.invert(is_cut))
        out = [cuts.drop_columns(["team"])]
        if found.num_rows:
            got = sorted(zip(*(found[c].to_pylist() for c in ("bucket", "block", "docs", "data"))),
                         key=lambda r: r[1])
            merged = _merge_bucket(got, length)
            if not more:
                merged = merged.filter(merged["docs"].is_null())
            team = pa.array([None if d is None else key[1].as_py() for d in merged["docs"].to_pylist()],
                            pa.int64())
            out.append(merged.set_column(1, "block", team))
        return pa.concat_tables(out)

    return run


KEPT = ("_bytes", "_n_bytes", "_n_removed", "_n_spans")


def with_cuts(docs: DataFrame, cuts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` and, as last column, the different cuts of the row's own text, so a list is bounded by
    its text however many rows have the id (or none)."""
    id_name, mark, found = fresh(docs, "_id", "_mark", "_cuts")
    spans = (cuts.groupBy(F.col("id").alias(id_name), F.col("mark").alias(mark))
             .agg(F.collect_set(F.struct("lo", "hi")).alias(found)))
    on = (_id(key) == F.col(id_name)) & (text_mark(text) == F.col(mark))
    return docs.join(spans, on, "left").select(*docs.columns, found)


def kept_texts(docs: DataFrame, cuts: DataFrame, key: str = "doc_id", text: str = "text",
               as_text: bool = False, names: tuple = KEPT) -> DataFrame:
    """``docs`` with what is left of the text, its bytes, how many of them were removed, and in how
    many spans, under ``names`` (which must not be columns of ``docs``). ``as_text``: what is left as
    a string, without the bytes left of a character that was cut."""
    joined = with_cuts(docs, cuts, key, text)
    columns = docs.columns
    first = T.StringType() if as_text else T.BinaryType()
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], first),
                           *(T.StructField(n, T.LongType()) for n in names[1:])])
    where = columns.index(text)

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(where).cast(pa.string()), "").cast(pa.binary())
            out = [[], [], [], []]
            for raw, found in zip(texts.to_pylist(), batch.column(len(columns)).to_pylist()):
                lo = hi = np.empty(0, np.int64)
                if found:
                    a = np.array(sorted((s["lo"], s["hi"]) for s in found))
                    top = np.maximum.accumulate(a[:, 1])
                    new = np.r_[True, a[1:, 0] > top[:-1]]
                    lo, hi = a[new, 0], np.r_[top[:-1][new[1:]], top[-1]]
                kept = b"".join(raw[x:y] for x, y in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)]))
                left = kept.decode(errors="ignore") if as_text else kept
                for col, v in zip(out, (left, len(raw), len(raw) - len(kept), len(lo))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(columns)], pa.array(out[0], pa.string() if as_text else pa.binary()),
                 *(pa.array(c, pa.int64()) for c in out[1:])], names=schema.names)
        tidy()

    return joined.mapInArrow(run, schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: what is left after passages of 50 bytes that a smaller id has."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return kept_texts(docs, removed(docs)).select(
        "doc_id", F.col("_n_bytes").alias("n_bytes"), F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"), F.sha2("_bytes", 256).alias("kept_sha256"))
