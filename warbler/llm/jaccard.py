"""N-gram Jaccard join: a grouped prefix join, exact, over whole texts.

A document's set holds its different shingles of ``words`` words (hashed to 64 bits). Documents link
when ``den`` · |intersection| ≥ ``num`` · |union|.

1. Documents of equal sets are one class; a class has an id made of its set.
2. Shingles are ordered by how common they are, then by hash. How common is read from a count sketch
   of fixed size over all documents; any order is right, a good one keeps common shingles out of the
   prefixes. Two sets can only link if they share one of their first n − ⌈t·n⌉ + 1 shingles.
3. Classes with the same prefix and size are one group. An inverted index holds a row per group and
   prefix shingle that another group has too: (shingle, place, size), and the first and the last
   group of the shingle. All its rows of one shingle, place and size are of one kind; pairs of kinds
   are tested first, by size and by the overlap that their places still allow, so a common shingle
   costs kinds², not rows².
4. Linking goes in rounds. In the first, each group that may link with the first group of one of its
   shingles is compared with one such group, and each class with one of its own group. Then only
   shingles of several components are live. The second round takes the last group of each live shingle
   in the same way, and each class that a pair of kinds names with one whose map (below) has an equal
   part. That joins large groups of near copies by a few comparisons for each member. The last round
   compares every pair of classes that any of the pairs of kinds names, unless they are already in one
   component. So no link between components is lost, and none within one is needed.
   A pair of classes is a row only at the first live shingle that it shares: kinds and rows that have
   the same live shingle before theirs met there. Pairs whose sets differ in more shingles than a link
   allows, by maps of 512 parities that each class has, are no rows of that join.
5. Verification: the sets of the classes in a round's pairs are built again where their texts are
   read: each task finds what is asked of it in a file of its own in the shared folder, so no text is
   shuffled; a task that misses one fails. Each pair (a, b) goes to b's place, where b's set is held
   while those of its partners stream by; a b with many partners has several places.
6. Components: every class takes its smallest neighbour as parent, parents are followed to the end,
   edges are contracted, until none is left. Which links a component has inside is not listed: the
   components need only that each is connected.

Rounds are cut by tables in the shared folder. No pairs, components or fingerprints come to the
driver. What is sent to all tasks has a fixed size: the sketch (16 MB).

Defined results. Null text, or text without words: no shingles, linked with nothing. Fewer words
than ``words``: the whole sequence is the one shingle. Null ids: rows like others, never the smallest
of a component that has an id. Rows of one id are rows each; equal texts are in one class whatever
their ids. Empty frames give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from warbler.llm.store import create, discard, exists, folder, fresh, passing, table, tidy, view

SKETCH_BITS = 24
SKETCH_BLOCK = 1 << 16
REMEMBERED = 200_000
_WORDS: dict[bytes, int] = {}
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: Bits of a set's parity map (see ``parities``): as many longs as columns in a join.
PARITY_BITS = 512
PARITIES = [f"p{i}" for i in range(PARITY_BITS // 64)]

ROWS = ("id long, mark long, task int, n long, class binary, group binary, prefix array<long>, "
        "parity array<long>")
#: What is asked of a task that reads texts.
ASKS = np.dtype([("mark", "<i8"), ("id", "<i8"), ("place", "<i8"), ("salt", "<i4"), ("is_head", "?"),
                 ("node", "<i8")])
PARTNERS = 2000
#: Texts counted in 16 bits before the counts are sent.
FLUSH = 65_000
NONE = -(1 << 63)


def _mixed(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The text's different shingles as sorted 64-bit hashes. Words are runs of bytes other than
    ASCII white space; A to Z are lower-cased."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    known = _WORDS
    try:
        h = [known[w] for w in parts]
    except KeyError:
        if len(known) > REMEMBERED:
            known.clear()
        for w in parts:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = [known[w] for w in parts]
    h = np.array(h, np.uint64)
    k = min(words, len(h))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):  # an odd factor for each place
        out = (out + h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(_mixed(out))


def parities(h: np.ndarray) -> np.ndarray:
    """For each of some bits, whether an odd number of shingles falls on it. Two maps differ in a bit
    only where a shingle is in one of the sets alone, so the number of bits in which they differ is
    at most that of such shingles."""
    odd = np.bincount((h & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix_size(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """Four times the logarithm of how many documents have a shingle, by the shingle's first bits:
    2**24 bytes. A task counts in 16 bits and sends its counts before they could overflow."""

    flush = FLUSH

    def parts_of(n):
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        parts = n.reshape(-1, SKETCH_BLOCK)
        used = np.flatnonzero(parts.any(axis=1))
        return pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)),
             # All low bytes, then all high ones: most are zero.
             pa.array([press.compress(parts[i].view(np.uint8).reshape(-1, 2).T.tobytes())
                       for i in used], pa.binary())], names=["part", "counts"])

    def count(batches):
        n, docs_seen = np.zeros(1 << SKETCH_BITS, np.uint16), 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                for text in batch["text"].slice(lo, 500).to_pylist():
                    h = shingles(text, words) >> np.uint64(64 - SKETCH_BITS)
                    n[h.astype(np.int64)] += np.uint16(1)  # shingles of one text that meet count once
                    docs_seen += 1
                    if docs_seen == flush:
                        yield parts_of(n)
                        n[:], docs_seen = 0, 0
        yield parts_of(n)
        _WORDS.clear()  # the worker goes on to other tasks
        tidy()

    def add(batches):
        import zstandard

        unpress, total = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for part, counts in zip(batch["part"].to_pylist(), batch["counts"].to_pylist()):
                low, high = np.frombuffer(unpress.decompress(counts), np.uint8).reshape(2, -1)
                own = low + (high.astype(np.int64) << 8)
                if part not in total:
                    total[part] = np.zeros(SKETCH_BLOCK, np.int64)
                total[part] += own
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([(4 * np.log2(1 + v)).astype(np.uint8).tobytes() for v in total.values()],
                      pa.binary())], names=["part", "counts"])

    counted = docs.mapInArrow(count, "part int, counts binary")
    got = counted.repartition(64, "part").mapInArrow(add, "part int, counts binary").toArrow()
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for part, counts in zip(got["part"].to_pylist(), got["counts"].to_pylist()):
        levels[part * SKETCH_BLOCK:(part + 1) * SKETCH_BLOCK] = np.frombuffer(counts, np.uint8)
    del got
    tidy()
    return levels


def _signatures(levels, words: int, num: int, den: int):
    def run(batches):
        level = levels.value
        for batch in batches:
            ids = batch["id"]
            for lo in range(0, batch.num_rows, 500):
                n, classes, groups, prefixes, maps = [], [], [], [], []
                for text in batch["text"].slice(lo, 500).to_pylist():
                    h = shingles(text, words)
                    n.append(len(h))
                    if not len(h):
                        classes.append(None)
                        groups.append(None)
                        prefixes.append(None)
                        maps.append(None)
                        continue
                    size = prefix_size(len(h), num, den)
                    rare = (level[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                            .astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))
                    p = h[np.argsort(rare, kind="stable")[:size]].view(np.int64)
                    classes.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    groups.append(hashlib.blake2b(p.tobytes() + len(h).to_bytes(8, "little"),
                                                  digest_size=16).digest())
                    prefixes.append(p)
                    maps.append(parities(h))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, 500), batch["mark"].slice(lo, 500),
                     batch["task"].slice(lo, 500), pa.array(n, pa.int64()), pa.array(classes, pa.binary()),
                     pa.array(groups, pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                     pa.array(maps, pa.list_(pa.int64()))],
                    names=["id", "mark", "task", "n", "class", "group", "prefix", "parity"])
        _WORDS.clear()
        tidy()

    return run


def _write_asks(path: str):
    """A file for each task that reads texts, with what is asked of it, sorted by mark."""

    def run(batches):
        task, parts = None, []

        def close():
            with create(f"{path}/{task}.bin") as out:
                out.write(np.concatenate(parts).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([task], pa.int32())], names=["task"])

        for batch in batches:
            tasks = batch["task"].to_numpy()
            asks = np.empty(batch.num_rows, ASKS)
            for name in ASKS.names:
                asks[name] = batch[name].to_numpy(zero_copy_only=False)
            for t in np.unique(tasks).tolist():  # sorted
                if t != task and parts:
                    yield close()
                    parts = []
                task = t
                parts.append(asks[tasks == t])
        if parts:
            yield close()

    return run


def _build(words: int, path: str):
    """(place, salt, is_head, node, set) for each ask of a text of this task."""

    def run(batches):
        asks, given = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if asks is None:
                uri = f"{path}/{batch['task'][0].as_py()}.bin"
                asks = np.array(view(uri, ASKS)) if exists(uri) else np.empty(0, ASKS)
                given = np.zeros(len(asks), bool)
            marks = pc.fill_null(batch["mark"], 0).to_numpy()
            ids = pc.fill_null(batch["id"], NONE).to_numpy()
            lo, hi = np.searchsorted(asks["mark"], marks), np.searchsorted(asks["mark"], marks, "right")
            rows = np.flatnonzero(hi > lo)
            for at in range(0, len(rows), 500):
                out, sets = [], []
                for i in rows[at:at + 500].tolist():
                    own = np.arange(lo[i], hi[i])
                    # Equal rows of one id are read once.
                    own = own[(asks["id"][own] == ids[i]) & ~given[own]]
                    if len(own):
                        given[own] = True
                        out.append(own)
                        sets += [shingles(batch["text"][i].as_py(), words).tobytes()] * len(own)
                if out:
                    found = asks[np.concatenate(out)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found["place"]), pa.array(found["salt"]), pa.array(found["is_head"]),
                         pa.array(found["node"]), pa.array(sets, pa.binary())],
                        names=["place", "salt", "is_head", "node", "set"])
        if asks is not None and not given.all():
            raise RuntimeError("texts are missing: the documents were read otherwise before")
        _WORDS.clear()
        tidy()

    return run


def _verify(num: int, den: int):
    """Sorted by place and salt, the head's set first."""

    def run(batches):
        head, own = None, None
        for batch in batches:
            a, b = [], []
            for place, salt, is_head, node, raw in zip(
                    *(batch[c].to_pylist() for c in ("place", "salt", "is_head", "node")), batch["set"]):
                own_set = np.frombuffer(raw.as_buffer(), np.uint64)
                if is_head:  # a copy: the batch goes
                    head, own = (place, salt), own_set.copy()
                elif head == (place, salt):
                    both = np.concatenate([own, own_set])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    if den * common >= num * (len(both) - common):
                        a.append(node)
                        b.append(place)
                else:
                    raise AssertionError("a pair without its head")
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                             names=["a", "b"])
        tidy()

    return run


def _may_link(num: int, den: int, a: str, b: str):
    """Whether rows a and b of the index may link, if theirs is the first shingle that they share."""
    na, nb, pa_, pb = (F.col(f"{x}.{c}") for c in ("n", "place") for x in (a, b))
    small, large = F.least(na, nb), F.greatest(na, nb)
    most = F.least(na - pa_, nb - pb)
    return (small * den >= large * num) & (most * (den + num) >= (na + nb) * num)


def _near(num: int, den: int, a: str, b: str):
    """Whether the parity maps of rows a and b allow a link. Sets that link differ in at most
    (den - num) / (den + num) of the sum of their sizes."""
    differ = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITIES), F.lit(0))
    return differ * (den + num) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


class _Join:
    """The rounds over one table of signatures."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int):
        self.words, self.num, self.den = words, num, den
        spark = docs.sparkSession
        levels = spark.sparkContext.broadcast(sketch(docs, words))
        self.docs = docs = docs.withColumn("task", F.spark_partition_id())
        signed = table(docs.mapInArrow(_signatures(levels, words, num, den), ROWS), "jaccard-signatures")
        some = signed.filter("n > 0")
        # Rows of a class agree in all but id and mark, and rows of a group in prefix and n.
        groups = table(some.groupBy("group").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
                       .withColumn("gid", F.monotonically_increasing_id()), "jaccard-groups")
        classes = some.groupBy("class").agg(
            F.min("id").alias("low"), F.min(F.struct("id", "mark", "task")).alias("one"),
            F.first("group").alias("group"), F.first("parity").alias("parity"))
        self.classes = table(
            classes.join(groups.select("group", "gid", "n"), "group")
            .select("class", "low", "one.id", "one.mark", "one.task", "gid", "n",
                    *[F.col("parity")[i].alias(p) for i, p in enumerate(PARITIES)]).withColumn(
                "node", F.monotonically_increasing_id()), "jaccard-classes")
        self.rows = table(signed.select("id", "mark", "n", "class"), "jaccard-rows")
        discard(signed)  # the prefixes are in the groups, and then in the index
        every = groups.select("gid", F.col("n").cast("int").alias("n"),
                              F.posexplode("prefix").alias("place", "shingle"))
        # The first and the last group of each shingle are kept beside it, so they are found once.
        own, row = Window.partitionBy("shingle"), F.struct("gid", "n", "place")
        self.index = table(every.withColumn("of", F.count(F.lit(1)).over(own)).filter("of > 1").drop("of")
                           .withColumn("first", F.min(row).over(own)).withColumn("last", F.max(row).over(own)),
                           "jaccard-index")
        discard(groups)
        self.members = self.classes.select("gid", "node")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that link."""
        pairs = table(pairs, "jaccard-pairs")
        heads = table(pairs.groupBy(F.col("b").alias("place"))
                      .agg((F.ceil(F.count(F.lit(1)) / PARTNERS)).cast("int").alias("salts")),
                      "jaccard-heads")
        # A table of its own, a row per PARTNERS pairs at most: few rows are sent to all tasks, many
        # are joined, and then the rows of a hot head are split.
        hot = table(heads.filter("salts > 1"), "jaccard-hot-heads")
        salt = F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int")
        partners = (pairs.join(hot, F.col("b") == F.col("place"), "left")
                    .select(F.col("b").alias("place"), salt.alias("salt"),
                            F.lit(False).alias("is_head"), F.col("a").alias("node")))
        each = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
        asks = partners.union(heads.select("place", each.alias("salt"), F.lit(True).alias("is_head"),
                                           F.col("place").alias("node")))
        asks = asks.join(self.classes.select("node", F.coalesce("id", F.lit(NONE)).alias("id"), "mark",
                                             "task"), "node")
        path = folder(self.docs.sparkSession, "jaccard-asks")
        table(asks.repartition("task").sortWithinPartitions("task", "mark")
              .mapInArrow(_write_asks(path), "task int"), "jaccard-asked")
        sets = self.docs.mapInArrow(
            _build(self.words, path), "place long, salt int, is_head boolean, node long, set binary")
        return table(sets.repartition("place", "salt")
                     .sortWithinPartitions("place", "salt", F.desc("is_head"))
                     .mapInArrow(_verify(self.num, self.den), "a long, b long").distinct(), "jaccard-links")

    def near_one(self, best, which: str, entries: DataFrame) -> DataFrame:
        """For each group one that may link with it among the first (last) groups of its shingles, as
        pairs of their first (last) classes; and each class with that of its group."""
        across = (entries.select("gid", "n", "place", F.col(which).alias("y")).alias("x")
                  .filter((F.col("gid") != F.col("y.gid")) & _may_link(self.num, self.den, "x", "y"))
                  .groupBy(F.col("gid").alias("x")).agg(best("y.gid").alias("y")))
        heads = table(self.members.groupBy("gid").agg(best("node").alias("head")), "jaccard-first")
        across = (across.join(heads.select(F.col("gid").alias("x"), F.col("head").alias("a")), "x")
                  .join(heads.select(F.col("gid").alias("y"), F.col("head").alias("b")), "y").select("a", "b"))
        inside = (self.members.join(heads, "gid").filter("node != head")
                  .select(F.col("node").alias("a"), F.col("head").alias("b")))
        return across.union(inside)

    def marked(self, labels: DataFrame) -> DataFrame:
        """The classes and their components."""
        return table(self.classes.select("gid", "node", "n", *PARITIES).join(labels, "node", "left")
                     .select("gid", "node", "n", F.coalesce("label", "node").alias("label"), *PARITIES),
                     "jaccard-labels")

    def live(self, entries: DataFrame, marked: DataFrame) -> DataFrame:
        """Those of the index's rows whose shingle is in classes of several components; ``lo`` and
        ``hi`` are the first and the last component of the row's group. Components only grow, so what
        is not live after a round never is again."""
        of = marked.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        dealt = entries.drop("lo", "hi").join(of, "gid").repartition("shingle")
        mixed = (dealt.groupBy("shingle").agg(F.min("lo").alias("least"), F.max("hi").alias("most"))
                 .filter("least != most").select("shingle"))
        return table(dealt.join(mixed, "shingle"), "jaccard-live")

    def alike(self, entries: DataFrame, marked: DataFrame) -> DataFrame:
        """Each class of these rows with one of another component that has the same parities in one
        of the map's parts of 32 bits, if the maps allow a link: a row per class and part."""
        some = marked.join(entries.select("gid").distinct(), "gid", "left_semi")
        parts = [part for p in PARITIES for part in (F.shiftrightunsigned(p, 32),
                                                     F.col(p).bitwiseAND(F.lit(0xFFFFFFFF)))]
        rows = (some.select("node", "label", F.posexplode(F.array(*parts)).alias("part", "bits"))
                .filter("bits != 0"))
        row = F.struct(F.xxhash64("node", "part").alias("draw"), "node", "label")
        one = rows.groupBy("part", "bits").agg(F.min(row).alias("one"))
        pairs = (rows.join(one, ["part", "bits"]).filter(F.col("label") != F.col("one.label"))
                 .select(F.least("node", "one.node").alias("a"), F.greatest("node", "one.node").alias("b"))
                 .distinct())
        x, y = marked.alias("x"), marked.alias("y")
        return (pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node"))
                .filter(_near(self.num, self.den, "x", "y")).select("a", "b"))

    def kind_pairs(self, live: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The pairs of kinds that may hold links between components, and the rows of those kinds. A
        pair comes up at the first shingle that it shares: where the live shingles before it are the
        same one, it isn't the first."""
        before = F.lag("shingle").over(Window.partitionBy("gid").orderBy("place"))
        entries = table(live.select("shingle", "n", "place", "gid", "lo", "hi", before.alias("before")),
                        "jaccard-entries")
        kinds = entries.repartition("shingle").groupBy("shingle", "place", "n").agg(
            F.count(F.lit(1)).alias("of"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            # Null unless all rows have one.
            F.when(F.count("before") == F.count(F.lit(1)), F.min("before")).alias("early"),
            F.when(F.count("before") == F.count(F.lit(1)), F.max("before")).alias("late"))
        a, b = kinds.alias("a"), kinds.alias("b")
        least, most = F.least("a.lo", "b.lo"), F.greatest("a.hi", "b.hi")
        one_before = ((F.col("a.early") == F.col("b.late")) & (F.col("a.late") == F.col("b.early"))
                      & (F.col("a.early") == F.col("a.late")))
        pairs = table(
            a.join(b, (F.col("a.shingle") == F.col("b.shingle"))
                   & (F.struct("a.n", "a.place") <= F.struct("b.n", "b.place"))
                   & _may_link(self.num, self.den, "a", "b")
                   & ((F.col("a.n") != F.col("b.n")) | (F.col("a.place") != F.col("b.place"))
                      | (F.col("a.of") > 1))
                   & (least != most) & ~F.coalesce(one_before, F.lit(False)))
            .select("a.shingle", F.col("a.n").alias("na"), F.col("a.place").alias("pa"),
                    F.col("b.n").alias("nb"), F.col("b.place").alias("pb")), "jaccard-kind-pairs")
        used = (pairs.select("shingle", F.col("na").alias("n"), F.col("pa").alias("place"))
                .union(pairs.select("shingle", "nb", "pb")).distinct())
        return pairs, table(entries.drop("lo", "hi").join(used, ["shingle", "n", "place"], "left_semi"),
                            "jaccard-entries-used")

    def all_left(self, pairs: DataFrame, entries: DataFrame, marked: DataFrame) -> DataFrame:
        """All pairs that may link and are not in one component, of the pairs of kinds and their rows."""
        members = self.live(entries, marked).drop("lo", "hi").join(marked.drop("n"), "gid")
        members = table(members, "jaccard-members")
        # Pairs of entries whose sets can't link by their parity maps are no rows of the join.
        x, y = members.alias("x"), members.alias("y")
        of_x = [F.col(f"k.{k}") == F.col(f"x.{c}") for k, c in
                (("shingle", "shingle"), ("na", "n"), ("pa", "place"))]
        of_y = [F.col(f"k.{k}") == F.col(f"y.{c}") for k, c in
                (("shingle", "shingle"), ("nb", "n"), ("pb", "place"))]
        once = ((F.col("k.na") != F.col("k.nb")) | (F.col("k.pa") != F.col("k.pb"))
                | (F.col("x.node") < F.col("y.node")))
        first = F.coalesce(F.col("x.before") != F.col("y.before"), F.lit(True))
        near = _near(self.num, self.den, "x", "y")
        across = (pairs.alias("k").join(x, reduce(and_, of_x))
                  .join(y, reduce(and_, [*of_y, F.col("x.label") != F.col("y.label"),
                                         F.col("x.gid") != F.col("y.gid"), once, first, near]))
                  .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        m, o = marked.alias("m"), marked.alias("o")
        inside = (m.join(o, (F.col("m.gid") == F.col("o.gid")) & (F.col("m.label") < F.col("o.label"))
                         & _near(self.num, self.den, "m", "o"))
                  .select(F.col("m.node").alias("a"), F.col("o.node").alias("b")))
        return (across.union(inside).select(F.least("a", "b").alias("a"),
                                            F.greatest("a", "b").alias("b")).distinct())


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component yet."""
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return (pairs.join(la, "a", "left").join(lb, "b", "left")
            .filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, label``: the components of (a, b), each named by one of its nodes. Every round each
    node takes its smallest neighbour as parent, if that is smaller than itself; parents are followed
    to the end, in steps that double; and edges are drawn between those ends instead. An end is
    smaller than all its neighbours, so no two ends are neighbours: a component at least halves with
    each round, and a round takes as many steps as the logarithm of its longest chain."""
    edges = table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .filter("a != b").distinct(), "components-edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        parents = table(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                        .select("node", F.least("node", "b").alias("label")), "components-parents")
        while True:
            up = parents.select(F.col("node").alias("label"), F.col("label").alias("up"))
            followed = table(parents.select("node", "label").join(up, "label").select(
                "node", F.col("up").alias("label"), (F.col("up") != F.col("label")).alias("moved")),
                "components-parents")
            parents = followed.select("node", "label")
            if followed.filter("moved").isEmpty():
                break
        if labels is None:
            labels = parents
        else:
            by = parents.select(F.col("node").alias("label"), F.col("label").alias("up"))
            labels = table(labels.join(by, "label", "left")
                           .select("node", F.coalesce("up", "label").alias("label")),
                           "components-labels")
        pa_ = parents.select(F.col("node").alias("a"), F.col("label").alias("la"))
        pb = parents.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = table(edges.join(pa_, "a").join(pb, "b")
                      .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
                      .filter("a != b").distinct(), "components-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
               num: int = 80, den: int = 100) -> DataFrame:
    """A row per row of ``docs``: ``id, mark, n_shingles, component`` (the smallest id that links
    reach). ``mark`` is xxhash64 of the text; it tells rows of one id apart."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                       F.xxhash64(F.col(text)).alias("mark"))
    with passing(docs.sparkSession) as keep:
        join = _Join(rows, words, num, den)
        edges = join.linked(join.near_one(F.min, "first", join.index))
        labels = connected(edges)
        marked = join.marked(labels)
        live = join.live(join.index, marked)
        kind_pairs, entries = join.kind_pairs(live)
        pairs = apart(join.near_one(F.max, "last", live), labels).union(join.alike(entries, marked))
        edges = edges.union(join.linked(pairs.distinct()))
        labels = connected(edges)
        left = join.all_left(kind_pairs, entries, join.marked(labels))
        labels = connected(edges.union(join.linked(left)))
        named = (join.classes.select("class", "low", "node").join(labels, "node", "left")
                 .withColumn("label", F.coalesce("label", "node")))
        least = named.groupBy("label").agg(F.min("low").alias("component"))
        of_class = named.join(least, "label").select("class", "component")
        return keep(table(join.rows.select("id", "mark", "n", "class").join(of_class, "class", "left")
                          .select("id", "mark", F.col("n").alias("n_shingles"),
                                  F.coalesce("component", "id").alias("component")), "jaccard-found"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
             num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: the first by id and ``mark``. Rows without shingles
    all stay. Null ids come last; without any id, the mark decides."""
    id_name, mark, one, rows, rank = fresh(docs, "_id", "_mark", "_one", "_rows", "_rank")
    with passing(docs.sparkSession) as keep:
        found = components(docs, key, text, words, num, den).withColumn("no_id", F.col("id").isNull())
        grouped = found.filter("n_shingles > 0")
        first = F.min(F.struct("no_id", "id", "mark")).alias("first")
        named = grouped.filter("component is not null").groupBy("component").agg(first)
        nameless = grouped.filter("component is null").select(F.struct("no_id", "id", "mark").alias("first"))
        times = found.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("times"))
        kept = (named.select("first.*").union(nameless.select("first.*"))
                .select("id", "mark", F.lit(True).alias("one"))
                .union(found.filter("n_shingles = 0").select("id", "mark", F.lit(False))).distinct())
        kept = (kept.alias("k").join(times.alias("t"), F.col("k.id").eqNullSafe(F.col("t.id"))
                                     & F.col("k.mark").eqNullSafe(F.col("t.mark")))
                .select(F.col("k.id").alias(id_name), F.col("k.mark").alias(mark),
                        F.col("one").alias(one), F.col("times").alias(rows)))
        kept = keep(table(kept, "jaccard-kept"))
    on = F.col(key).cast("long").eqNullSafe(F.col(id_name)) & (F.xxhash64(F.col(text)) == F.col(mark))
    joined = docs.join(kept, on)
    # Equal rows of one id: only they are brought together again.
    again = F.col(one) & (F.col(rows) > 1)
    nth = F.row_number().over(Window.partitionBy(id_name, mark).orderBy(one))
    first = joined.filter(again).withColumn(rank, nth).filter(F.col(rank) == 1).drop(rank)
    return joined.filter(~again).unionByName(first).select(*docs.columns)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: components of a Jaccard similarity of 0.9 or more on 3-word shingles."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return components(docs, words=3, num=90, den=100).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
