"""Archives read back, against the oracle's rule and by hand."""

import struct

import zstandard
from pyspark.sql import functions as F

import lociframe.llm.warc as W
from lociframe.llm.warc import frames, page_of, payload_digest, read_archives, record, record_id, train_dictionary, write_archives

SF = "/root/testdata/sf0.01"


def test_record_ids_hold_page_ids():
    for i in (0, 1, -1, -7, 2**63 - 1, -2**63, None):
        assert page_of(record_id(i, "D")) == i


def test_archives_start_with_the_dictionary_and_records_stand_alone(spark):
    manifest = write_archives(spark.read.parquet(f"{SF}/pages.parquet")).collect()
    assert sum(r.records for r in manifest) == 250
    data = open(manifest[0].path.removeprefix("file:"), "rb").read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and size > 1000
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    assert d.decompressobj().decompress(data[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    assert len(list(frames(manifest[0].path))) == manifest[0].records + 1


def test_rolling_and_reading_in_small_pieces(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(W, "READ_BYTES", 7)
    samples = [record(i, f"http://x/{i}", f"<p>{i * 7919 % 1000} words and more words {i}</p>".encode(), None) for i in range(300)]
    d = train_dictionary(samples)
    a = W.Archive(str(tmp_path / "a.warc.zst"), d, zstandard.ZstdCompressor(dict_data=W.as_dictionary(d)))
    for s in samples:
        a.add(s)
    path, n, _ = a.close()
    assert list(frames(path))[1:] == samples and n == 300


def result(spark, rows, **kw):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("key", F.lit(2))
    return sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in read_archives(write_archives(df, **kw)).collect())


def test_corner_cases(spark):
    rows = [(5, "u", None), (3, None, ""), (4, "a b\r\né", "é<p>"), (9, "u", "é<p>"), (None, "u", "é<p>"), (7, "u", "x" * 100_000), (3, None, "")]
    empty, e = payload_digest(b""), payload_digest("é<p>".encode())
    assert result(spark, rows) == [(-1, 5, e, "response", None), (3, 0, empty, "response", None), (3, 0, empty, "response", None),
                                   (4, 5, e, "response", None), (5, 0, empty, "revisit", 3),
                                   (7, 100_000, payload_digest(b"x" * 100_000), "response", None), (9, 5, e, "revisit", 4)]
    assert [r[3] for r in result(spark, rows, min_bytes=1)] == ["response"] * 6 + ["revisit"]
    assert result(spark, [], min_bytes=0) == []


def test_large_pages_get_a_dictionary(spark):
    words = [f"word{i * 7919 % 5000}" for i in range(3000)]
    rows = [(i, f"http://x/{i}", "<html><head>" + "<meta name=common>" * 40 + "</head>" + " ".join(words[i:] + words[:i]) + f"<p>{i}</p>") for i in range(120)]
    manifest = write_archives(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert min(len(r[2]) for r in rows) > W.SAMPLE_BYTES
    for r in manifest:
        magic, size = struct.unpack("<II", open(r.path.removeprefix("file:"), "rb").read(8))
        assert magic == 0x184D2A5D and size == r.dictionary_bytes > 1000


def test_clashing_columns(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    more = df.withColumns({c: F.lit("clash") for c in ("payload", "key", "first_id", "wanted", "last_id", "a.b")})
    assert sorted(map(str, read_archives(write_archives(more)).collect())) == sorted(map(str, read_archives(write_archives(df)).collect()))
