"""WARC 1.1 archives of web pages, compressed with a Zstandard dictionary per archive.

An archive ``part-NNNNN.warc.zst`` is

1. a skippable frame (magic 0x184D2A5D) that holds a dictionary built from the archive's first
   records, itself a Zstandard frame;
2. one frame for each record, compressed on its own with that dictionary: ``warcinfo`` first, then
   a ``response`` or ``revisit`` record per page.

A reader needs nothing but the file, and any record can be read by its frame's offset. Payloads
that occur more than once are stored once: of the records with equal payloads of at least
``revisit_bytes``, the one with the largest page id is the response; the others are revisits that
name it in ``WARC-Refers-To`` and carry the payload's digest and length, but no payload.

Choosing the responses aggregates (payload digest, page id) before any shuffle, so a payload with a
third of all pages is a row per task. Only digests that occur twice are joined back, from a table of
their own: few are sent to the tasks, and pages stay where they are read; with many, pages are dealt
by digest, those that have none to share by a hash of their own, and Spark splits the pages of a hot
payload, as the other side has one row for it. Each task writes one archive, holding the records of
``sample_bytes`` at most until its dictionary is made.

Defined results. Null html or url: empty. A null page id is written as such and is a response only
if no other page has its payload. Repeated rows are records of their own; those with the winning
page id are responses each. An empty frame gives no archives. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from warbler.llm.store import create, folder, open_stream, table

MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
DATE = "2009-06-01T00:00:00Z"
RECORDS = "page_id long, url string, html binary, digest string, refers_to long, response boolean"
PARTS = "file string, records long"
PAGES = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
         "refers_to long")


def with_revisits(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """``pages`` (page_id, url, html) with the payload's SHA-1 ``digest``, ``refers_to`` and
    ``response``."""
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        html.alias("html"))
    # SHA-256 tells payloads apart; SHA-1 is what the archive reports. Payloads that are too short to
    # be revisited have 8 bytes instead of 32, which meet nothing.
    long = F.octet_length("html") >= revisit_bytes
    own = F.to_binary(F.lpad(F.hex(F.xxhash64("page_id", "url")), 16, "0"), F.lit("hex"))
    rows = (rows.withColumn("digest", F.sha1("html"))
            .withColumn("same", F.when(long, F.unhex(F.sha2("html", 256))).otherwise(own)))
    kept = table(rows.filter(long).groupBy("same")
                 .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                 .select("same", "kept"), "warc-kept")
    joined = rows.join(kept, "same", "left")
    response = F.col("kept").isNull() | F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select("page_id", "url", "html", "digest",
                         F.when(~response, F.col("kept")).alias("refers_to"),
                         response.alias("response"))


def write_archives(pages: DataFrame, revisit_bytes: int = 1000, dictionary_bytes: int = 64 << 10,
                   sample_bytes: int = 4 << 20, level: int = 3, path: str | None = None) -> str:
    """Writes the archives and returns their folder; its ``index`` (Parquet) lists them."""
    spark = pages.sparkSession
    path = path or folder(spark, "warc")
    rows = with_revisits(pages, revisit_bytes)
    written = rows.withColumn("part", F.spark_partition_id()).mapInArrow(
        _writer(path, dictionary_bytes, sample_bytes, level), PARTS)
    written.write.parquet(f"{path}/index")
    return path


def record(page_id, url: str, html: bytes, sha1: str, refers_to, response: bool) -> bytes:
    """One WARC record; a revisit has the response's HTTP head only."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(html)}\r\n\r\n").encode()
    block = http + html if response else http
    base32 = base64.b32encode(bytes.fromhex(sha1)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if response else 'revisit'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {url.translate({10: '%0A', 13: '%0D'})}",
             f"WARC-Payload-Digest: sha1:{base32}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if not response:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _build_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples' own ends where they are too few to train on."""
    import zstandard

    heads = [s[:16 << 10] for s in samples]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, heads)) // 8)),
                                          heads).as_bytes()
    except zstandard.ZstdError:
        return b"".join(heads)[-size:]


def _writer(path: str, dictionary_bytes: int, sample_bytes: int, level: int):
    def write(batches):
        import zstandard

        rows = (r for b in batches for r in zip(*(b[c].to_pylist() for c in (
            "page_id", "url", "html", "digest", "refers_to", "response", "part"))))
        first, held = [], 0
        part = None
        for r in rows:
            part = r[6]
            first.append(record(*r[:6]))
            held += len(first[-1])
            if held >= sample_bytes:
                break
        if not first:
            return
        words = _build_dictionary(first, dictionary_bytes)
        name = f"{path}/part-{part:05d}-{uuid.uuid4().hex[:8]}.warc.zst"
        press = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(words))
        n = 0
        with create(name) as out:
            frame = zstandard.ZstdCompressor(level=19).compress(words)
            out.write(struct.pack("<II", MAGIC, len(frame)) + frame)
            body = b"software: warbler\r\nformat: WARC File Format 1.1\r\n"
            info = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:archive:{part}>\r\n"
                    f"WARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\n"
                    f"Content-Length: {len(body)}\r\n\r\n").encode()
            out.write(press.compress(info + body + b"\r\n\r\n"))
            for data in itertools.chain(first, (record(*r[:6]) for r in rows)):
                out.write(press.compress(data))
                n += 1
            first.clear()
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())],
                                         names=["file", "records"])

    return write


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per page record, from the archives alone: ``page_id, payload_bytes, payload_digest,
    record_type, refers_to``. A response's figures come from its payload, which must agree with its
    header; a revisit's from its header."""
    files = spark.read.parquet(f"{path}/index")
    # A task for about each archive: the index itself is too small for Spark to spread it.
    return files.repartition(max(1, files.count()), "file").mapInArrow(_read, PAGES)


class _Records:
    """Whole records of one archive in order, a frame at a time."""

    def __init__(self, stream):
        import zstandard

        magic, size = struct.unpack("<II", stream.read(8))
        assert magic == MAGIC, "no dictionary frame"
        words = zstandard.ZstdDecompressor().decompress(stream.read(size))
        self.stream = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(words)).stream_reader(
                stream, read_across_frames=True, read_size=1 << 20)
        self.buffer = b""

    def _exactly(self, n: int) -> bytes:
        while len(self.buffer) < n:
            more = self.stream.read(max(1 << 16, n - len(self.buffer)))
            assert more, "a record that doesn't end"
            self.buffer += more
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got

    def __iter__(self):
        while True:
            while (end := self.buffer.find(b"\r\n\r\n")) < 0:
                more = self.stream.read(1 << 16)
                if not more:
                    assert not self.buffer, "a record that doesn't end"
                    return
                self.buffer += more
            lines = self._exactly(end + 4)[:-4].decode().split("\r\n")
            head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            yield head, self._exactly(int(head["Content-Length"]) + 4)[:-4]


def _number(uri: str):
    digits = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _read(batches):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for files in batches:
        for name in files["file"].to_pylist():
            rows = []
            with open_stream(name) as stream:
                for head, block in _Records(stream):
                    kind = head["WARC-Type"]
                    if kind == "warcinfo":
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    digest = base64.b32decode(head["WARC-Payload-Digest"][5:]).hex()
                    if kind == "response":
                        own = hashlib.sha1(payload).hexdigest()
                        assert (len(payload), own) == (size, digest), "a damaged payload"
                    refers = _number(head["WARC-Refers-To"]) if kind == "revisit" else None
                    rows.append((_number(head["WARC-Record-ID"]), size, digest, kind, refers))
                    if len(rows) == 5000:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written to archives and read back from them."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_archives(spark, write_archives(pages))


#: The same without archives.
OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (
  SELECT html, max(page_id) AS kept, count(*) AS n FROM p WHERE strlen(html) >= 1000
  GROUP BY html HAVING count(*) > 1)
SELECT page_id, strlen(p.html) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN kept IS NULL OR kept IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN kept IS DISTINCT FROM page_id THEN kept END AS refers_to
FROM p LEFT JOIN k ON k.html = p.html
"""
