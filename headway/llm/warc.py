"""WARC archives with an index, read back by coalesced byte ranges.

Writing: each task writes ``.warc.gz`` files (one gzip member per record, so
that a record can be read alone) into a shared folder and returns an index
row per record: file, offset, length, url, digest.  The index is committed by
Spark as a Parquet table; files of failed or repeated attempts carry other
names and are in no index.  Reading: the selected index rows are grouped by
file and stretch, sorted by offset, neighbouring ranges merge into one read,
and every response payload is checked against its digest.

Of rows with equal payloads of at least ``min_bytes`` bytes, the one with the
smallest key is a response and the others are revisits that refer to it.  Rows
that repeat both key and payload are alike: of the smallest key, all are
responses.  A null payload is an empty one; a null key is larger than any
other and is referred to only if all keys of its payload are null.  A null url
gets a urn; control characters and spaces in a url are percent-encoded in the
archive, the index keeps it as it is.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import fresh_folder, staged, utf8

INDEX = ("key bigint, url string, record_type string, refers_to bigint, payload_digest string, "
         "payload_bytes bigint, file string, `offset` bigint, length bigint")
RECORD = ("key bigint, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload string")
DATE = "2024-01-01T00:00:00Z"
_HEADER = re.compile(rb"([^\r\n:]+): ?([^\r\n]*)\r\n")


def _record_id(key: int | None) -> str:
    return f"<urn:x-page:{'null' if key is None else key}>"


def _key_of(record_id: str) -> int | None:
    text = record_id.strip("<>").rpartition(":")[2]
    return None if text == "null" else int(text)


def record_bytes(key: int | None, url: str | None, payload: bytes, digest: str, response: bool,
                 refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else (
        _record_id(key).strip("<>"))
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http + payload if response else http
    head = [("WARC-Type", "response" if response else "revisit"), ("WARC-Record-ID", _record_id(key)),
            ("WARC-Date", date), ("WARC-Target-URI", target),
            ("WARC-Payload-Digest", f"sha1:{digest}")]
    if not response:
        head += [("WARC-Profile",
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", _record_id(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(body)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(text.encode("utf-8", "surrogatepass") + body + b"\r\n\r\n", 6, mtime=0)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_record(raw: bytes) -> tuple:
    """(key, payload_bytes, payload_digest, record_type, refers_to, payload);
    raises where the payload doesn't have its digest."""
    cut = raw.index(b"\r\n\r\n") + 4
    head = {k.decode().lower(): v.decode("utf-8", "surrogatepass")
            for k, v in _HEADER.findall(raw[:cut - 2])}
    body = raw[cut:cut + int(head["content-length"])]
    cut = body.index(b"\r\n\r\n") + 4
    http = {k.lower(): v for k, v in _HEADER.findall(body[:cut - 2])}
    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    size = int(http[b"content-length"])
    if kind == "response" and (digest_of(body[cut:]) != digest or len(body) - cut != size):
        raise ValueError(f"damaged record {head['warc-record-id']}")
    refers = _key_of(head["warc-refers-to"]) if kind == "revisit" else None
    return (_key_of(head["warc-record-id"]), size, digest, kind, refers,
            body[cut:].decode("utf-8", "surrogatepass") if kind == "response" else None)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   payload: str = "html", min_bytes: int = 0,
                   max_file_bytes: int = 1 << 30) -> DataFrame:
    """Write every row as a record under ``folder``/archive and return the index
    (kept as a table in ``folder``/index)."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        utf8(payload).alias("payload"))
    rows = rows.withColumn("sha1", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    narrow = rows.select("key", "sha1", F.octet_length("payload").alias("size"))
    first = staged(narrow.groupBy("sha1").agg(F.min("key").alias("first")), "warc-first")
    # One small row per (key, payload), so that the wide rows are dealt by key:
    # a payload that fills a third of all rows lands nowhere as a group.
    roles = (narrow.distinct().join(first, "sha1")
             .select(F.col("key").alias("k"), F.col("sha1").alias("s"), "first",
                     (F.col("key").eqNullSafe(F.col("first")) | (F.col("size") < min_bytes))
                     .alias("response")))
    full = (rows.join(roles, rows.key.eqNullSafe(roles.k) & (rows.sha1 == roles.s))
            .select("key", "url", "payload", "response", "first"))
    target = f"{folder}/archive"

    def run(batches):
        store, base = pafs.FileSystem.from_uri(target)
        store.create_dir(base, recursive=True)
        out = name = None
        at = 0
        try:
            for b in batches:
                index = []
                for k, u, p, response, ref in zip(*(c.to_pylist() for c in b.columns)):
                    if out is None or at >= max_file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = p.encode("utf-8", "surrogatepass")
                    digest = digest_of(data)
                    record = record_bytes(k, u, data, digest, response, ref)
                    out.write(record)
                    index.append((k, u, "response" if response else "revisit",
                                  None if response else ref, digest, len(data), name, at, len(record)))
                    at += len(record)
                if index:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, f.type) for x, f in zip(zip(*index), arrow)], schema=arrow)
        finally:
            if out is not None:
                out.close()

    arrow = pa.schema([("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                       ("payload_bytes", pa.int64()), ("file", pa.string()),
                       ("offset", pa.int64()), ("length", pa.int64())])
    full.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def coalesce(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, int, int]]:
    """Sorted (offset, length) ranges as reads (start, stop, first, last range):
    ranges less than ``gap`` bytes apart share a read of up to ``most`` bytes."""
    reads: list[list[int]] = []
    for i, (offset, length) in enumerate(ranges):
        if reads and offset - reads[-1][1] <= gap and offset + length - reads[-1][0] <= most:
            reads[-1][1] = max(reads[-1][1], offset + length)
            reads[-1][3] = i + 1
        else:
            reads.append([offset, offset + length, i, i + 1])
    return [tuple(r) for r in reads]


def read_records(selected: DataFrame, folder: str, stretch: int = 32 << 20, gap: int = 64 << 10,
                 most: int = 8 << 20) -> DataFrame:
    """The records of the selected index rows, read from the archives (payload
    is null for revisits)."""
    target = f"{folder}/archive"
    spark = selected.sparkSession
    # Index rows are small, what they stand for isn't: the number of tasks
    # follows the bytes to read, so it is given (and not merged at run time).
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // stretch))
    ranges = (selected.select("file", "offset", "length")
              .withColumn("part", F.floor(F.col("offset") / stretch))
              .repartition(tasks, "file", "part").sortWithinPartitions("file", "offset"))

    def run(batches):
        store, base = pafs.FileSystem.from_uri(target)
        name = handle = None
        for b in batches:
            files = b.column(0).to_pylist()
            spans = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            i = 0
            while i < len(files):
                j = i
                while j < len(files) and files[j] == files[i]:
                    j += 1
                if name != files[i]:
                    if handle is not None:
                        handle.close()
                    name = files[i]
                    handle = store.open_input_file(f"{base}/{name}")
                for start, stop, x, y in coalesce(spans[i:j], gap, most):
                    data = handle.read_at(stop - start, start)
                    records = []
                    for offset, length in spans[i + x:i + y]:
                        member = data[offset - start:offset - start + length]
                        records.append(parse_record(zlib.decompress(member, 31)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*records), arrow)], schema=arrow)
                i = j
        if handle is not None:
            handle.close()

    arrow = pa.schema([("key", pa.int64()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()),
                       ("refers_to", pa.int64()), ("payload", pa.string())])
    return ranges.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url",
               payload: str = "html") -> DataFrame:
    """Write all rows, then read all records back."""
    folder = fresh_folder(pages.sparkSession, "warc")
    return read_records(write_archives(pages, folder, key, url, payload), folder)
