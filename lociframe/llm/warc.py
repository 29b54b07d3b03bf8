"""WARC archives with a shared Zstandard dictionary.

A dictionary is trained on a bounded sample of the records that are archived
(``SAMPLE_ROWS`` rows, those with the smallest id hash; of a payload over
``SAMPLE_BYTES`` its two ends, half of that each).  The manifest says how long the
dictionary is, 0 if the sample allows none.  Every archive starts with a skippable frame that holds the
dictionary, then each record is a Zstandard frame of its own, so a record can be
read with the first frame and its own offset.

Records with equal payloads are stored once: that of the smallest page id is the
``response``, the others are ``revisit`` records that refer to it and carry the
HTTP head only (so also the payload's length) and the payload's digest.

Scale: payload groups meet as (hash, smallest id); only groups of several pages
are kept for the join, and Spark sends them to the executors only if their
measured size is small.  Each task writes archives of about ``ARCHIVE_BYTES`` to
the shared folder under a name of its own and returns them as a manifest, so
what a lost or repeated task leaves behind is never read.

Defined results: null html is an empty payload; payloads under ``min_bytes`` are
always responses; rows that repeat the smallest page id of their payload are all
responses; rows with a null page id are responses and never referred to; an
empty table gives no archive and an empty result.  Only the named columns are
read, so further columns never clash.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import shared_folder, small_hash, stored

SAMPLE_ROWS = 400
SAMPLE_BYTES = 20_000
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
READ_BYTES = 1 << 18

# The frame that holds a dictionary, and names of the format.
DICTIONARY_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"      # the pages carry no date
NAMESPACE = 0x6C6F63696672         # high 48 bits of the record ids


def record_id(page_id: int | None, digest: str) -> str:
    """A version 8 UUID that holds the page id (null: part of the digest)."""
    if page_id is None:
        low, mark = int.from_bytes(hashlib.sha256(digest.encode()).digest()[:8], "big") >> 2, 0x800
    else:
        raw = page_id & ((1 << 64) - 1)
        low, mark = raw & ((1 << 62) - 1), raw >> 62
    return f"<urn:uuid:{uuid.UUID(int=NAMESPACE << 80 | (0x8000 | mark) << 64 | 1 << 63 | low)}>"


def page_of(urn: str) -> int | None:
    v = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    mark = v >> 64 & 0xFFF
    if mark & 0x800:
        return None
    raw = mark << 62 | v & ((1 << 62) - 1)
    return raw - (1 << 64) if raw >> 63 else raw


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = payload_digest(payload)
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if not revisit:
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url:
        head.append(f"WARC-Target-URI: {quote(url, safe='!#$%&()*+,/:;=?@[]~')}")
    if revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary over sample records; empty where they are too few or too alike."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def as_dictionary(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def opened(path: str, mode: str):
    """A file of the shared folder, which all executors reach under one name."""
    if urlsplit(path).scheme in ("", "file"):
        local = urlsplit(path).path
        if mode == "wb":
            os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, mode)
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    return store.open_output_stream(name) if mode == "wb" else store.open_input_stream(name)


class Archive:
    """One .warc.zst file that is being written."""

    def __init__(self, path: str, dictionary: bytes, compressor: zstandard.ZstdCompressor):
        self.path, self.compressor, self.records = path, compressor, 0
        self.file = opened(path, "wb")
        self.bytes = 0
        if dictionary:
            self._put(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
        info = b"software: lociframe\r\nformat: WARC File Format 1.1\r\n"
        self._put(compressor.compress(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\n"
                                      f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))

    def _put(self, data: bytes) -> None:
        self.file.write(data)
        self.bytes += len(data)

    def add(self, data: bytes) -> None:
        self._put(self.compressor.compress(data))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.file.close()
        return self.path, self.records, self.bytes


def frames(path: str) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    with opened(path, "rb") as f:
        data = f.read(max(8, READ_BYTES))
        decompressor = zstandard.ZstdDecompressor()
        if len(data) >= 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_FRAME:
            size = struct.unpack("<I", data[4:8])[0]
            while len(data) < 8 + size:
                more = f.read(READ_BYTES)
                if not more:
                    raise ValueError(f"{path}: the dictionary frame is cut off")
                data += more
            decompressor = zstandard.ZstdDecompressor(dict_data=as_dictionary(data[8:8 + size]))
            data = data[8 + size:]
        while data or (data := f.read(READ_BYTES)):
            frame, out = decompressor.decompressobj(), []
            while not frame.eof:
                if not data and not (data := f.read(READ_BYTES)):
                    raise ValueError(f"{path}: the last record is cut off")
                out.append(frame.decompress(data))
                data = frame.unused_data
            yield b"".join(out)


def parse(data: bytes) -> dict | None:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: the record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not fit its digest")
    return {"page_id": page_of(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None}


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Archive every row of (page_id, url, html); the manifest (path, records,
    bytes, dictionary_bytes), stored in the shared folder beside the archives."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    key = F.unhex(F.sha2("payload", 256))
    groups = (rows.where(F.col("page_id").isNotNull() & (F.octet_length("payload") >= min_bytes)).select(key.alias("key"), "page_id")
              .groupBy("key").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
              .where("first_id < last_id").select("key", "first_id"))
    groups = stored(groups, "payload-groups")
    drawn = small_hash(F.xxhash64("page_id"), SAMPLE_ROWS, rows.count())
    half = SAMPLE_BYTES // 2
    ends = F.when(F.octet_length("payload") > SAMPLE_BYTES, F.concat(F.substring("payload", 1, half), F.substring("payload", -half, half))).otherwise(F.col("payload"))
    sample = (rows.where(drawn).select("page_id", "url", ends.alias("payload")).orderBy(F.xxhash64("page_id"), "page_id", "url")
              .limit(SAMPLE_ROWS).collect())
    dictionary = spark.sparkContext.broadcast(train_dictionary([record(r.page_id, r.url, bytes(r.payload), None) for r in sample]))
    folder = shared_folder(spark, "warc")

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=as_dictionary(dictionary.value))
        done, archive = [], None
        for b in batches:
            for page_id, url, payload, first in zip(*(b.column(i).to_pylist() for i in range(4))):
                if archive is None:
                    archive = Archive(f"{folder}/{uuid.uuid4().hex}.warc.zst", dictionary.value, compressor)
                archive.add(record(page_id, url, payload, first if first != page_id else None))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        columns = [*(zip(*done) if done else [()] * 3), [len(dictionary.value)] * len(done)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                                         names=["path", "records", "bytes", "dictionary_bytes"])

    # a null page id joins nothing, so its record is a response
    wanted = F.when(F.col("page_id").isNotNull() & (F.octet_length("payload") >= min_bytes), F.unhex(F.sha2("payload", 256)))
    joined = rows.withColumn("wanted", wanted).join(groups, F.col("wanted") == F.col("key"), "left")
    return stored(joined.select("page_id", "url", "payload", "first_id").mapInArrow(run, "path string, records long, bytes long, dictionary_bytes long"), "warc-manifest")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every page record of the manifest's archives, digests checked."""
    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                for data in frames(path):
                    if (row := parse(data)) is not None:
                        rows.append(row)
                    if len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2)
    return manifest.select("path").repartition(tasks).mapInArrow(run, READ)
