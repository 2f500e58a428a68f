"""WARC writing, and reading by boundary-chain verification.

``write_archives`` writes one record per page with the JVM's text writer (records end in CRLF CRLF, files hold at most
``RECORDS_PER_FILE`` records, gzip), with revisit records for payloads that an earlier page has. ``read_archives``
scans files in tasks: wherever the record magic stands, a candidate is emitted with the offset of the record that its
length says comes next. A magic inside a payload is a candidate too, but no chain from the file's start leads to it:
the offsets of a file meet again, and pointer jumping doubles the distance in each round and keeps what is reachable.

Defined results: a null html is an empty payload; pages with equal payloads of at least ``MIN_REVISIT`` bytes revisit
the smallest page id among them, every row with that id is a response; a page with a null id is always a response; a
null url is left out; repeated rows are records each; an empty table gives no records; other columns are not read. A
page id of text is percent-encoded in its record, so any character comes back. A length that leads beyond its file, or
of more than 18 digits, makes no candidate. A file holds at most ``RECORDS_PER_FILE`` records and, by the largest
payload there is, at most ``FILE_BYTES`` before compression, unless a single record is larger.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, new_path, slices, stage

VERSION = "WARC/1.1"
MIN_REVISIT = 0
RECORDS_PER_FILE = 500
#: Readers hold a whole file; Spark's own bound on a value is 2 GB.
FILE_BYTES = 1 << 28
#: More than any header written here has.
HEAD_BYTES = 8192
DATE = "2000-01-01T00:00:00Z"
_LENGTH = re.compile("[0-9]{1,18}")
_HEAD = re.compile(rb"(?:(?<=\r\n)|\A)" + VERSION.encode() + rb"\r\n((?:[!-9;-~]+:[^\r\n]*\r\n)+)\r\n")


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, html (not null), size, digest (bare base32 SHA-1)."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            raw = [(x or "") for x in b.column(2).to_pylist()]
            data = [x.encode() for x in raw]
            digest = [base64.b32encode(hashlib.sha1(x).digest()).decode() for x in data]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.string()), pa.array(list(map(len, data)), pa.int64()), pa.array(digest, pa.string())], names=["page_id", "url", "html", "size", "digest"])

    return map_arrow(pages.select("page_id", "url", "html"), work, f"page_id {kind}, url string, html string, size long, digest string")


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of ``pages`` as gzip WARC files in ``path``, any folder that Spark can write."""
    found = stage(payloads(pages), "payloads")
    largest = found.agg(F.max("size")).first()[0] or 0
    records_per_file = max(1, min(records_per_file, FILE_BYTES // (largest + HEAD_BYTES)))
    known = found.where(F.col("page_id").isNotNull() & (F.col("size") >= min_revisit))
    owners = stage(known.groupBy("digest").agg(F.min("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1").select("digest", "owner"), "owners")
    placed = found.join(owners, "digest", "left")
    revisit = F.col("page_id").isNotNull() & F.col("owner").isNotNull() & (F.col("size") >= min_revisit) & (F.col("page_id") != F.col("owner"))
    uid = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.concat(F.lit("="), F.url_encode(F.col(c).cast("string"))), F.lit("")), F.lit(">"))
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit("\r\n"))
    clean = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    head = F.concat(
        F.lit(VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", uid("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", clean), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("size").cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", uid("owner")), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit("\r\n"),
    )
    record = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("html")), F.lit("\r\n"))
    placed.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def _unpacked(data: bytes) -> bytes:
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:  # a file may hold one gzip member for each record
        d = zlib.decompressobj(31)
        out.append(d.decompress(data))
        data = d.unused_data
    return b"".join(out)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, successor, and the header fields of whatever looks like a record; payload digests only where the record's end fits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "offset", "successor", "type", "page", "refers", "said", "said_bytes", "digest", "n_bytes"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for b in batches:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                data, rows = _unpacked(content.as_py()), []
                for m in _HEAD.finditer(data):
                    fields = dict(x.split(": ", 1) for x in m[1].decode("utf-8", "replace").split("\r\n") if ": " in x)
                    size = fields.get("Content-Length", "")
                    if not _LENGTH.fullmatch(size) or (end := m.end() + int(size)) + 4 > len(data):
                        continue
                    fits = data[end : end + 4] == b"\r\n\r\n" and (end + 4 == len(data) or data.startswith(VERSION.encode() + b"\r\n", end + 4))
                    digest = base64.b32encode(hashlib.sha1(data[m.end() : end]).digest()).decode() if fits else None
                    said = fields.get("WARC-Payload-Length", "")
                    uid = lambda k, f=fields: f.get(k, "")[11:-1] if f.get(k, "").startswith("<urn:page:=") else None
                    rows.append((file.as_py(), m.start(), end + 4, fields.get("WARC-Type"), uid("WARC-Record-ID"), uid("WARC-Refers-To"), fields.get("WARC-Payload-Digest", "")[5:], int(said) if _LENGTH.fullmatch(said) else None, digest, int(size)))
                for at in range(0, len(rows), 5000):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[at : at + 5000], strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return map_arrow(files, work, "file string, offset long, successor long, type string, page string, refers string, said string, said_bytes long, digest string, n_bytes long")


def chained(offset: np.ndarray, successor: np.ndarray) -> np.ndarray:
    """Which of a file's candidates (sorted offsets) the chain from offset 0 reaches, by pointer jumping.

    In each round every reached candidate reaches the one its pointer leads to, and every pointer jumps as far again,
    so rounds follow the logarithm of the chain's length. A successor that is no candidate ends a chain.
    """
    n = len(offset)
    to = np.searchsorted(offset, successor)
    jump = np.append(np.where((to < n) & (offset[np.minimum(to, n - 1)] == successor), to, n), n)
    reached = np.zeros(n + 1, bool)
    reached[0] = offset[0] == 0
    while (jump[:n] < n).any():
        reached[jump[np.flatnonzero(reached[:n])]] = True
        jump = jump[jump]
    return reached[:n]


def reachable(found: DataFrame) -> DataFrame:
    """The rows of staged ``candidates`` that the chain from offset 0 of their file reaches. A file's offsets, 16 bytes each, meet in one task; nothing else does."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file: str | None = None
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            offset, successor = (np.concatenate(x) for x in zip(*held, strict=True))
            true = offset[chained(offset, successor)]
            return pa.RecordBatch.from_arrays([pa.array([file] * len(true), pa.string()), pa.array(true, pa.int64())], names=["file", "offset"])

        for b in batches:
            names = b.column(0).to_pylist()
            offset, successor = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            at = 0
            while at < len(names):
                end = bisect.bisect_right(names, names[at], at)
                if names[at] != file and held:
                    yield made()
                    held = []
                file = names[at]
                held.append((offset[at:end], successor[at:end]))
                at = end
        if held:
            yield made()

    pointers = found.select("file", "offset", "successor").repartition("file").sortWithinPartitions("file", "offset")
    return found.join(map_arrow(pointers, work, "file string, offset long"), ["file", "offset"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, record_type, page (text of the id), refers, payload_bytes, payload_digest of the archives' true records."""
    kept = reachable(stage(candidates(spark, path), "candidates"))
    own = F.col("type") == "response"
    return kept.select(
        "file", "offset", F.col("type").alias("record_type"), "page", "refers", F.when(own, F.col("n_bytes")).otherwise(F.col("said_bytes")).alias("payload_bytes"), F.when(own, F.col("digest")).otherwise(F.col("said")).alias("payload_digest")
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from archives written to and read from the shared folder."""
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType
    path = new_path(spark, "warc")
    write_archives(pages, path)
    found = read_archives(spark, path)
    ident = lambda c: F.url_decode(F.col(c)).cast(kind)
    return found.select(ident("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", ident("refers").alias("refers_to"))
