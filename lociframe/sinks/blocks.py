"""Text as block gzip (BGZF): every part can be read from any block on."""

from __future__ import annotations

import os
import struct
import zlib
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame

BLOCK = 0xFF00           # bytes of text in a block
# A member's header up to its size, and the empty last block.
HEADER = b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff\x06\x00BC\x02\x00"
END = HEADER + b"\x1b\x00\x03\x00" + bytes(8)


def block(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return HEADER + struct.pack("<H", len(HEADER) + 2 + len(body) + 8 - 1) + body + struct.pack("<II", zlib.crc32(data), len(data))


def store_of(path: str):
    """(file system, name in it) of a path or URI."""
    from pyarrow import fs
    try:
        return fs.FileSystem.from_uri(path)
    except (ValueError, TypeError):
        return fs.LocalFileSystem(), path


def write_block_gzip(lines: DataFrame, path: str, suffix: str = ".vcf.bgz") -> DataFrame:
    """Write the first column of ``lines`` below ``path`` (a folder that the tasks
    reach), one file per partition in partition order; returns the files written
    (``path``, ``n_lines``, ``n_bytes``), which is lazy: an action on it writes."""
    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get()
        store, folder = store_of(path)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/part-{part.partitionId():05d}{suffix}"
        # a repeated task writes a file of its own and moves it into place
        own = f"{folder}/_{part.partitionId():05d}-{part.taskAttemptId()}.tmp"
        n = 0
        with store.open_output_stream(own) as out:
            held = bytearray()
            for pdf in batches:
                n += len(pdf)
                held += "".join(line + "\n" for line in pdf.iloc[:, 0]).encode()
                while len(held) >= BLOCK:
                    out.write(block(bytes(held[:BLOCK])))
                    del held[:BLOCK]
            if held:
                out.write(block(bytes(held)))
            out.write(END)
            size = out.tell()
        store.move(own, name)
        yield pd.DataFrame({"path": [name], "n_lines": [n], "n_bytes": [size]})

    return lines.mapInPandas(run, "path string, n_lines long, n_bytes long")


COPY = 8 << 20           # bytes held while a part is copied


def join_block_gzip(parts: DataFrame, path: str, in_place: bool | None = None) -> int:
    """Join the files of ``write_block_gzip`` into the one file ``path`` by bytes, in
    partition order, without their last (empty) blocks but one: nothing is packed
    again.  In a folder that all tasks mount (``in_place``, the default for paths),
    each task writes its parts at their places; a store without such writes (the
    default for other URIs) gets one stream, in bounded memory.  Returns the size.  Repeated tasks write the same bytes again."""
    # one short row per part
    listed = sorted(((r["path"], r["n_bytes"]) for r in parts.select("path", "n_bytes").collect()))
    sizes = [n - len(END) for _, n in listed]
    total = sum(sizes) + len(END)
    spark = parts.sparkSession
    target = urlsplit(path).path if urlsplit(path).scheme == "file" else path
    in_place = "://" not in target if in_place is None else in_place
    if not in_place:
        rows = [(0, p, n) for (p, _), n in zip(listed, sizes)]
        placed = spark.createDataFrame(rows, "at long, path string, n long").coalesce(1).sortWithinPartitions("path")
    else:
        os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
        with open(target, "wb") as out:
            out.truncate(total)
            out.seek(total - len(END))
            out.write(END)
        starts = [sum(sizes[:i]) for i in range(len(sizes))]
        rows = [(a, p, n) for a, (p, _), n in zip(starts, listed, sizes)]
        placed = spark.createDataFrame(rows, "at long, path string, n long").repartition(max(1, len(rows)))

    def run(batches):
        from lociframe.sources.blocks import open_file

        def pieces(part, n):
            with open_file(part) as f:
                while n:
                    data = f.read(min(n, COPY))
                    yield data
                    n -= len(data)

        if not in_place:
            store, name = store_of(target)
            store.create_dir(os.path.dirname(name), recursive=True)
            with store.open_output_stream(name) as out:
                for pdf in batches:
                    for part, n in zip(pdf["path"], pdf["n"]):
                        for data in pieces(part, n):
                            out.write(data)
                out.write(END)
            yield pd.DataFrame({"n": [total]})
            return
        for pdf in batches:
            for at, part, n in zip(pdf["at"], pdf["path"], pdf["n"]):
                fd = os.open(target, os.O_WRONLY)
                try:
                    for data in pieces(part, n):
                        os.pwrite(fd, data, at)
                        at += len(data)
                finally:
                    os.close(fd)
            yield pd.DataFrame({"n": pdf["n"]})

    placed.mapInPandas(run, "n long").count()
    return total
