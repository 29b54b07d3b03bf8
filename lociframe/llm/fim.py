"""Fill-in-the-middle transformation by rotating blocks in place.

A text is cut into prefix, middle and suffix.  It is copied once into a
bytearray, sentinels are inserted at the cuts, and the two neighbouring blocks
that have to change places (middle and suffix, or prefix with middle and suffix)
are exchanged by three reversals.  The rotation the other way round, with the
sentinels taken out, gives the exact text back: a text that holds a sentinel is
left plain, and no text around a sentinel can form another one.

Forms: ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle;
``plain`` is the text itself.  Cuts and form come from the SHA-256 of the salt, a
colon and the row's id, so they do not depend on partitions or repetitions.

Defined results: a null text is an empty text, which is plain; a null id counts
as an empty one in the hash; repeated rows give equal rows; an empty table gives
an empty result.  Only the id and the text are read, so further columns never
clash.  Lengths are code points.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"      # fixed values
BLOCK = 1 << 16            # bytes exchanged, or looked at, at a time
BATCH_BYTES = 8 << 20


def reverse(buf: bytearray, i: int, j: int) -> None:
    """Reverse ``buf[i:j]`` in place, a block from either end at a time."""
    while j - i > 1:
        k = min(BLOCK, (j - i) // 2)
        head = buf[i:i + k]
        buf[i:i + k] = buf[j - k:j][::-1]
        buf[j - k:j] = head[::-1]
        i, j = i + k, j - k


def rotate(buf: bytearray, i: int, cut: int, j: int) -> None:
    """Exchange the blocks ``buf[i:cut]`` and ``buf[cut:j]`` by three reversals."""
    reverse(buf, i, cut)
    reverse(buf, cut, j)
    reverse(buf, i, j)


def code_points(data: bytes) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at) & 0xC0) != 0x80))
               for at in range(0, len(data), BLOCK))


def byte_places(data: bytes, places: list[int]) -> list[int]:
    """Byte offsets of ascending code point offsets, in one scan of the text."""
    out, seen = [], 0
    for at in range(0, len(data), BLOCK):
        if len(out) == len(places):
            break
        starts = np.flatnonzero((np.frombuffer(data, np.uint8, min(BLOCK, len(data) - at), at) & 0xC0) != 0x80)
        while len(out) < len(places) and places[len(out)] < seen + len(starts):
            out.append(at + int(starts[places[len(out)] - seen]))
        seen += len(starts)
    return out + [len(data)] * (len(places) - len(out))


def draw(salt: str, key: str) -> list[int]:
    digest = hashlib.sha256(f"{salt}:{key}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def rotated(data: bytes, h: list[int], plain_from: int, spm_below: int) -> tuple[str, int, int | None, int | None, bytes]:
    """(form, n, prefix_chars, middle_chars, output) of a text."""
    n = code_points(data)
    if not data or h[2] % 100 >= plain_from or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", n, None, None, data
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    first, second = byte_places(data, [a, b])
    buf = bytearray(data)
    buf[second:second] = SUFFIX
    buf[first:first] = MIDDLE
    buf[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    form = "spm" if h[3] % 100 < spm_below else "psm"
    rotate(buf, 0 if form == "spm" else middle, suffix, len(buf))
    return form, n, a, b - a, bytes(buf)


def restored_bytes(form: str, output: bytes) -> bytes:
    """The text that an output of ``rotated`` came from."""
    if form == "plain":
        return output
    buf = bytearray(output)
    p, s, m = buf.find(PREFIX), buf.find(SUFFIX), buf.find(MIDDLE)
    # the block that stands in front now went there from behind
    if form == "spm":
        rotate(buf, 0, p, len(buf))
    else:
        rotate(buf, s, m, len(buf))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buf.find(sentinel)
        del buf[at:at + len(sentinel)]
    return bytes(buf)


def _batches(rows, names, kinds):
    """Record batches of bounded size from tuples whose last field is binary."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size >= BATCH_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", salt: str = "1",
              plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row;
    ``output`` is text.  Of 100 texts those from ``plain_from`` on stay plain, and
    of the others ``spm_below`` in 100 are ``spm``."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        def rows():
            for b in batches:
                for i, t in zip(b.column(0), b.column(1)):
                    i, t = i.as_py(), t.as_py() or b""
                    form, n, p, m, out = rotated(t, draw(salt, "" if i is None else str(i)), plain_from, spm_below)
                    yield i, n, form, p, m, out
        yield from _batches(rows(), names, kinds)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return (narrow.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary")
            .withColumn("output", F.col("output").cast("string")))


def restore(made: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored): the exact
    texts, rebuilt from ``output`` and ``form`` alone."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches):
        def rows():
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    yield *r, restored_bytes(r[2], r[5])
        yield from _batches(rows(), names, kinds)

    narrow = made.select(*names[:5], F.col("output").cast("binary").alias("output"))
    return (narrow.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary, restored binary")
            .withColumns({c: F.col(c).cast("string") for c in ("output", "restored")}))
