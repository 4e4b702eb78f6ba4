"""Token ids of text columns, as the public ``tokenizers`` file gives them, batch by batch.

``Encoder`` gives exactly the ids of ``Tokenizer.encode(text, add_special_tokens=False)``. A
byte-level BPE file encodes each pre-token on its own, so a slice of texts is cut into pre-tokens at
once: the bytes get their character's class from a table, and the rules of the public pattern become
comparisons of neighbouring classes in numpy. Each different pre-token of a slice is encoded by the
library's model once, what it gave is remembered, and the ids are gathered back in text order. Texts
with white space of several bytes or with a special token's string, and files of another kind, go
through the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Classes of characters: letters, numbers, white space, all others.
LETTER, NUMBER, SPACE, OTHER = range(4)
#: What may follow an apostrophe to make a pre-token of its own (fixed values of the public pattern).
SHORT, LONG = b"stmd", (b"re", b"ve", b"ll")
#: Pre-tokens that are remembered: twice as many are held at most.
REMEMBERED = 250_000
#: Bytes of text handled at once.
SLICE_BYTES = 8 << 20

_ENCODERS: dict[str, "Encoder"] = {}
_CLASSES: list[np.ndarray] = []


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> "Encoder":
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASSES:
        import regex

        table = np.full(0x110000, OTHER, np.uint8)
        places = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
        every = places.astype("<u4").tobytes().decode("utf-32-le")
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[places[m.start():m.end()]] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def byte_classes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte's character, and the places of white space of several bytes."""
    table = classes()
    kinds = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return kinds, lead
    b = [data[np.minimum(lead + j, len(data) - 1)].astype(np.int32) for j in range(4)]
    two, three = b[0] < 0xE0, b[0] < 0xF0
    points = np.where(
        two, (b[0] & 0x1F) << 6 | b[1] & 0x3F, np.where(
            three, (b[0] & 0x0F) << 12 | (b[1] & 0x3F) << 6 | b[2] & 0x3F,
            (b[0] & 0x07) << 18 | (b[1] & 0x3F) << 12 | (b[2] & 0x3F) << 6 | b[3] & 0x3F))
    own = table[np.minimum(points, 0x10FFFF)]
    for j, there in enumerate((slice(None), slice(None), ~two, ~three)):
        kinds[lead[there] + j] = own[there]
    return kinds, lead[own == SPACE]


def pre_tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens start in the UTF-8 ``data`` of texts that start at ``starts`` (empty ones
    left out); and the places of white space that these rules don't cover."""
    kinds, odd = byte_classes(data)
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[starts], first[n] = True, True
    space = kinds == SPACE
    changes = np.ones(n, bool)
    np.not_equal(kinds[1:], kinds[:-1], out=changes[1:])
    changes |= first[:-1]
    # The last of a run of white space, if it is not the text's last character.
    ends = np.zeros(n, bool)
    ends[:-1] = space[:-1] & ~space[1:]
    ends &= ~first[1:]
    attached = np.zeros(n, bool)  # to the blank before
    attached[1:] = ends[:-1] & (data[:-1] == 32)
    found = (changes | ends) & ~attached
    quotes = np.flatnonzero(found & (data == 39))
    if len(quotes):
        pad = np.concatenate([data, np.zeros(3, np.uint8)])
        whole = np.concatenate([first, np.ones(3, bool)])
        one, two = pad[quotes + 1], pad[quotes + 2]
        short = np.isin(one, np.frombuffer(SHORT, np.uint8)) & ~whole[quotes + 1]
        long = np.zeros(len(quotes), bool)
        for pair in LONG:
            long |= (one == pair[0]) & (two == pair[1])
        long &= ~whole[quotes + 1] & ~whole[quotes + 2]
        taken = short | long
        found[quotes[taken] + 1] = False
        after = quotes[taken] + np.where(long[taken], 3, 2)
        # What follows starts anew; for all but letters it does so anyway.
        after = after[after < n]
        found[after[kinds[after] == LETTER]] = True
    return np.flatnonzero(found), odd


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (
            (spec.get("model") or {}).get("type") == "BPE" and spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True)
        )
        if self.by_piece:
            self.model = self.whole.model
            # The printable stand-in of each byte in byte-level vocabularies, as a rule: printable
            # Latin characters stand for themselves, the others are numbered from 256 on.
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
            hidden = [b for b in range(256) if b not in shown]
            self.stand_in = {**dict(zip(shown, shown)), **{b: 256 + i for i, b in enumerate(hidden)}}
            self.stand_in = {i: chr(c) for i, c in self.stand_in.items()}
            # Pre-tokens that are remembered, the slice each was last used in, and their ids.
            self.known = pa.array([], pa.large_binary())
            self.used = np.empty(0, np.int64)
            self.starts = np.empty(0, np.int64)
            self.lengths = np.empty(0, np.int64)
            self.arena = np.empty(0, self.dtype)
            self.slices = 0

    def encode(self, texts: pa.Array):
        """Yields (ids, counts) for consecutive slices of ``texts`` (null: empty): the ids of the
        slice end to end, and the number of ids of each text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy())
        start = 0
        while start < len(texts):
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, "right")))
            yield self._slice(texts.slice(start, end - start))
            start = end

    def _slice(self, texts: pa.Array):
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:][:len(texts) + 1]
        lo, hi = int(offsets[0]), int(offsets[-1])
        if not self.by_piece or lo == hi:
            return self._plain(texts.to_pylist())
        data = np.frombuffer(texts.buffers()[2], np.uint8)[lo:hi]
        offsets = offsets - lo
        starts, odd = pre_tokens(data, offsets[:-1][offsets[:-1] < offsets[1:]])
        other = np.zeros(len(texts), bool)
        other[np.searchsorted(offsets, odd, "right") - 1] = True
        for token in self.special:
            other |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        places = np.append(starts, hi - lo)
        tokens = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                       [None, pa.py_buffer(places), pa.py_buffer(data)])
        coded = tokens.dictionary_encode()
        where = self._known(coded.dictionary)[coded.indices.to_numpy()]
        cuts = np.searchsorted(starts, offsets)  # each text's first pre-token
        if not other.any():
            return self._gather(where, cuts)
        kept = np.repeat(~other, np.diff(cuts))
        counts = np.zeros(len(texts), np.int64)
        own, counts[~other] = self._gather(where[kept], np.append(
            0, np.cumsum(np.diff(cuts)[~other])))
        rest, counts[other] = self._plain(texts.filter(pa.array(other)).to_pylist())
        ids, place = np.empty(counts.sum(), self.dtype), np.repeat(other, counts)
        ids[~place], ids[place] = own, rest
        return ids, counts

    def _gather(self, where: np.ndarray, cuts: np.ndarray):
        n = self.lengths[where]
        ends = np.cumsum(n)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(self.starts[where] - (ends - n), n)
        ids, counts = self.arena[at], np.diff(np.append(0, ends)[cuts])
        if len(self.known) > 2 * REMEMBERED:  # the half used last is kept
            self._keep(np.sort(np.argpartition(-self.used, REMEMBERED)[:REMEMBERED]))
        return ids, counts

    def _keep(self, kept: np.ndarray) -> None:
        n = self.lengths[kept]
        ends = np.cumsum(n)
        at = np.arange(ends[-1]) + np.repeat(self.starts[kept] - (ends - n), n)
        self.arena, self.starts, self.lengths = self.arena[at], ends - n, n
        self.known, self.used = self.known.take(pa.array(kept)), self.used[kept]

    def _known(self, distinct: pa.Array) -> np.ndarray:
        """The places of pre-tokens among the remembered; the model encodes those that are not."""
        self.slices += 1
        where = pc.index_in(distinct, value_set=self.known)
        new = where.is_null().to_numpy(zero_copy_only=False)
        where = where.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            words = distinct.filter(pa.array(new))
            tokenize, show = self.model.tokenize, self.stand_in
            got = [[t.id for t in tokenize("".join([show[b] for b in w]))]
                   for w in words.to_pylist()]
            lengths = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter((i for each in got for i in each), self.dtype, int(lengths.sum()))
            where[new] = len(self.known) + np.arange(len(words))
            self.starts = np.concatenate([self.starts, len(self.arena) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.arena = np.concatenate([self.arena, ids])
            self.used = np.concatenate([self.used, np.zeros(len(words), np.int64)])
            self.known = pa.concat_arrays([self.known, words])
        self.used[where] = self.slices
        return where

    def _plain(self, texts: list[str]):
        got = [np.array(e.ids, self.dtype)
               for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        return (np.concatenate(got) if got else np.empty(0, self.dtype),
                np.array([len(x) for x in got], np.int64))
