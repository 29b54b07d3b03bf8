"""Lines of block-compressed files, read by byte range."""

import gzip
import random
import struct
import zlib
from itertools import combinations_with_replacement

import pytest
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.operators import cohort as CO
from lociframe.operators import split as SP
from lociframe.sinks import blocks as KB
from lociframe.sinks import vcf as KV
from lociframe.sources import blocks as B
from lociframe.sources import vcf as SV

HEAD = ['##INFO=<ID=AC,Number=A,Type=Integer,Description="c">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="f">',
        '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">']
COLS = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"


def bgzip(data: bytes, block: int) -> bytes:
    out = b""
    for i in [*range(0, len(data), block), len(data)]:
        part = data[i:i + block]
        c = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = c.compress(part) + c.flush()
        size = 12 + 6 + len(body) + 8
        out += b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, size - 1)
        out += body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("packed", [lambda d: bgzip(d, 700), lambda d: bgzip(d, 60), lambda d: d, gzip.compress])
def test_ranges_give_every_line_once(tmp_path, packed):
    rng = random.Random(1)
    lines = ["x" * rng.choice([0, 1, 5, 80, 400, 3000]) + str(i) for i in range(300)]
    for end in ("\n", ""):
        path = str(tmp_path / f"f{len(end)}")
        data = packed(("\n".join(lines) + end).encode())
        open(path, "wb").write(data)
        numbers = None
        for step in (50, 997, 20_000, 10**9):
            found = [(n, x.decode()) for s in range(0, len(data), step)
                     for at, some in B.range_lines(path, s, min(s + step, len(data)), len(data)) for n, x in zip(at, some)]
            assert [x for _, x in found] == lines
            # the same numbers, rising, whatever the ranges
            numbers = numbers or [n for n, _ in found]
            assert [n for n, _ in found] == numbers and sorted(set(numbers)) == numbers


def vcf(samples, records):
    return "\n".join([*HEAD, COLS + "".join("\t" + s for s in samples), *records]) + "\n"


def test_folder_of_block_files_equals_plain_text(spark, tmp_path, monkeypatch):
    records = [f"chr1\t{i + 1}\tv{i}\tA\tC,G\t.\tPASS\tAC={i},2;DB\tGT\t0/1\t{'1|2' if i % 2 else './.'}" for i in range(2000)]
    (tmp_path / "plain").mkdir()
    (tmp_path / "packed").mkdir()
    (tmp_path / "plain" / "a.vcf").write_text(vcf(["S1", "S2"], records))
    (tmp_path / "packed" / "a.vcf.bgz").write_bytes(bgzip(vcf(["S1", "S2"], records[:1500]).encode(), 4000))
    (tmp_path / "packed" / "b.vcf.gz").write_bytes(bgzip(vcf(["S1", "S2"], records[1500:]).encode(), 4000))
    monkeypatch.setattr(B, "RANGE_BYTES", 3000)
    out = []
    for name in ("plain", "packed"):
        v = SV.read_vcf(spark, str(tmp_path / name))
        out.append((sorted(map(str, v.sites.drop("file_id", "record").collect())), sorted(map(str, v.calls.drop("file_id", "record").collect()))))
        assert v.sites.select("file_id", "record").distinct().count() == 2000
        sites, calls = v.sites.select("file_id", "record", "rsid"), v.calls.select("file_id", "record", "position")
        assert all(r.rsid == f"v{r.position - 1}" for r in sites.join(calls, ["file_id", "record"]).collect())
    assert out[0] == out[1]


def test_files_with_other_samples_are_refused(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(vcf(["S1"], ["chr1\t1\t.\tA\tC\t.\t.\tAC=1\tGT\t0/1"]))
    (tmp_path / "b.vcf").write_text(vcf(["T1"], ["chr1\t2\t.\tA\tC\t.\t.\tAC=1\tGT\t0/1"]))
    with pytest.raises(ValueError, match="other sample columns"):
        SV.read_vcf(spark, str(tmp_path))
    assert SV.read_vcf(spark, str(tmp_path), drop_samples=True).sites.count() == 2


def test_calls_keep_what_was_written(spark, tmp_path):
    texts = ["0/.", "./1", ".", "1", "0|1", "1/0", "./."]
    (tmp_path / "a.vcf").write_text(vcf([f"S{i}" for i in range(7)], ["chr1\t1\t.\tA\tC\t.\t.\tAC=7;AC=9;DB;DB\tGT\t" + "\t".join(texts)]))
    v = SV.read_vcf(spark, str(tmp_path / "a.vcf"))
    calls = {r.s: None if r.GT is None else (r.GT.a1, r.GT.a2, r.GT.phased) for r in v.calls.collect()}
    assert [calls[f"S{i}"] for i in range(7)] == [None, None, None, (1, None, False), (0, 1, True), (1, 0, False), None]
    site = v.sites.first()
    assert site.info.AC == [7] and site.info.DB is True


def test_sites_and_calls_of_two_jobs_join(spark, tmp_path, monkeypatch):
    """Record numbers do not depend on ranges, tasks or the file's neighbours."""
    records = [f"chr1\t{1 + i // 2}\tv{i}\tA\tC\t.\t.\tAC={i}\tGT\t{'0/1' if i % 3 else '1/1'}" for i in range(400)]
    text = vcf(["S1"], records).encode()
    for name, data in (("a.vcf", text), ("b.vcf.gz", gzip.compress(text)), ("c.vcf.bgz", bgzip(text, 300))):
        folder = tmp_path / name.replace(".", "_")
        folder.mkdir()
        (folder / name).write_bytes(data)
        monkeypatch.setattr(B, "RANGE_BYTES", 32 << 20)
        v = SV.read_vcf(spark, str(folder))
        v.sites.select("file_id", "record", "rsid", "position").write.parquet(str(folder / "sites"))
        monkeypatch.setattr(B, "RANGE_BYTES", 211)
        calls = SV.read_vcf(spark, str(folder / name)).calls.select("file_id", "record", F.col("position").alias("at"), "GT")
        both = spark.read.parquet(str(folder / "sites")).join(calls, ["file_id", "record"]).collect()
        assert len(both) == 400 and all(r.position == r["at"] and (r.GT.a1 == 0) == (int(r.rsid[1:]) % 3 > 0) for r in both)


def test_long_lines_take_linear_work(tmp_path, monkeypatch):
    """Every decoded byte is searched a bounded number of times, whatever the
    length of the lines."""
    class Counted(bytes):
        seen = 0

        def find(self, *a):
            Counted.seen += len(self) - (a[1] if len(a) > 1 else 0)
            return bytes.find(self, *a)

        def rfind(self, *a):
            Counted.seen += len(self)
            return bytes.rfind(self, *a)

        def split(self, *a):
            Counted.seen += len(self)
            return bytes.split(self, *a)

        def __getitem__(self, k):
            return Counted(bytes.__getitem__(self, k)) if isinstance(k, slice) else bytes.__getitem__(self, k)

    chunks = B.range_chunks
    monkeypatch.setattr(B, "range_chunks", lambda *a: ((at, Counted(d), m) for at, d, m in chunks(*a)))
    work = []
    for length in (1000, 100_000, 2_000_000):
        path = str(tmp_path / f"{length}.vcf.bgz")
        data = (b"x" * (length - 1) + b"\n") * (2_000_000 // length)
        open(path, "wb").write(packed := bgzip(data, 20_000))
        Counted.seen = 0
        assert sum(len(x) + 1 for _, some in B.range_lines(path, 0, len(packed), len(packed)) for x in some) == 2_000_000
        work.append(Counted.seen)
    assert max(work) < 5 * 2_000_000


def test_calls_of_any_ploidy(spark, tmp_path):
    texts = ["0/0/1", "2|1|0|1", "0/./1", "1/1/1/2/0", "0/1", "1"]
    (tmp_path / "b.vcf").write_text(vcf([f"S{i}" for i in range(6)], ["chr1\t1\t.\tA\tC,G\t.\t.\tAC=1,1\tGT\t" + "\t".join(texts)]))
    v = SV.read_vcf(spark, str(tmp_path / "b.vcf"))
    calls = {r.s: r.GT and (r.GT.a1, r.GT.a2, r.GT.phased, r.GT.more) for r in v.calls.collect()}
    assert [calls[f"S{i}"] for i in range(6)] == [(0, 0, False, [1]), (2, 1, True, [0, 1]), None, (1, 1, False, [1, 2, 0]), (0, 1, False, None), (1, None, False, None)]
    line = KV.record_lines(v.sites, v.calls, v.samples).first().line
    assert line.split("\t")[9:] == ["0/0/1", "2|1|0|1", "./.", "1/1/1/2/0", "0/1", "1"]
    split = SP.split_calls(v.calls).collect()
    coded = {(r.s, r.a_index): r.GT and [x for x in (r.GT.a1, r.GT.a2, *(r.GT.more or [])) if x is not None] for r in split}
    assert coded["S0", 1] == [0, 0, 1] and coded["S1", 1] == [0, 1, 0, 1] and coded["S1", 2] == [1, 0, 0, 0]
    assert coded["S3", 1] == [0, 0, 1, 1, 1] and coded["S3", 2] == [0, 0, 0, 0, 1] and coded["S4", 2] == [0, 0] and coded["S5", 1] == [1]
    counts = CO.variant_qc(v.calls).first()
    every = [x for i in (0, 1, 3, 4, 5) for x in {0: [0, 0, 1], 1: [2, 1, 0, 1], 3: [1, 1, 1, 2, 0], 4: [0, 1], 5: [1]}[i]]
    assert counts.AC == [every.count(k) for k in range(3)] and counts.AN == len(every)


def test_likelihoods_of_any_ploidy(spark):
    """Minimum per number of copies, over genotypes written out in their order."""
    for n, ploidy in ((2, 1), (3, 1), (2, 3), (3, 3), (4, 4), (3, 2), (5, 3)):
        order = sorted(combinations_with_replacement(range(n), ploidy), key=lambda g: g[::-1])
        pl = [(i * 37 + 11) % 101 for i in range(len(order))]
        df = spark.createDataFrame([(pl, a, n) for a in range(1, n)], "PL array<int>, a_index int, num_alleles int")
        for r in G.with_split_pl(df).collect():
            assert r.PL == [min(x for x, g in zip(pl, order) if g.count(r.a_index) == c) for c in range(ploidy + 1)], (n, ploidy)
    odd = spark.createDataFrame([([1, 2, 3, 4, 5], 1, 3)], "PL array<int>, a_index int, num_alleles int")
    assert G.with_split_pl(odd).first().PL is None


def test_one_block_gzip_file_from_parts(spark, tmp_path):
    sites = spark.range(5000).select(F.when(F.col("id") % 2 == 0, "chr2").otherwise("chrM").alias("contig"), (F.col("id") + 1).alias("position"),
                                     F.array(F.lit("A"), F.lit("C")).alias("alleles")).repartition(7)
    header = SV.parse_header_lines([*HEAD, "##contig=<ID=chrM>", "##contig=<ID=chr2,length=9>"])
    path = str(tmp_path / "one.vcf.bgz")
    size = KV.write_vcf_bgz(spark, header, sites, path, str(tmp_path / "parts"))
    data = open(path, "rb").read()
    assert len(data) == size and data.endswith(KB.END) and data.count(KB.END) == 1
    text = gzip.decompress(data).decode().splitlines()
    assert [x.split("\t")[0] for x in text if x[0] != "#"] == ["chrM"] * 2500 + ["chr2"] * 2500 and text[0].startswith("##fileformat")
    lines = B.read_ranges(spark, B.list_files(spark, path), range_bytes=2000)
    assert lines.rdd.getNumPartitions() > 3 and sorted(r.value for r in lines.collect()) == sorted(text)
    # a store without writes in place takes one stream
    again = KB.join_block_gzip(KB.write_block_gzip(spark.createDataFrame([("x",), ("y",)], "line string").coalesce(1), str(tmp_path / "p2")), str(tmp_path / "two.bgz"), in_place=False)
    assert gzip.open(tmp_path / "two.bgz").read() == b"x\ny\n" and again == (tmp_path / "two.bgz").stat().st_size


def test_contigs_stand_together_and_descriptions_survive(spark, tmp_path):
    rows = [("chrUn_KI1", 10), ("chrM", 20), ("chr2", 5), ("chrUn_KI1", 20), ("chrM", 10), ("chr10", 1)]
    sites = spark.createDataFrame([(c, p, ["A", "C"]) for c, p in rows], "contig string, position long, alleles array<string>")
    info = '##INFO=<ID=Q,Number=1,Type=String,Description="a \\"q\\" \\\\ b",Source="tool, \\"x\\"",Version="3">'
    for contigs, want in (([], "chr2 chr10 chrM chrM chrUn_KI1 chrUn_KI1"), (["##contig=<ID=chrM>", "##contig=<ID=chr10>"], "chrM chrM chr10 chr2 chrUn_KI1 chrUn_KI1")):
        header = SV.parse_header_lines([info, *contigs])
        assert header.info["Q"] == {"Number": "1", "Type": "String", "Description": 'a "q" \\ b', "Source": 'tool, "x"', "Version": "3"}
        path = str(tmp_path / f"out{len(contigs)}")
        KV.write_vcf(spark, header, sites, path, compression="none")
        lines = [r.value for r in spark.read.text(path).collect()]
        assert " ".join(x.split("\t")[0] for x in lines if x[0] != "#") == want
        assert SV.parse_header_lines(lines).info == header.info and info in lines
        KV.write_vcf_shards(spark, header, sites.withColumn("shard", F.lit("a")), "shard", path + "s", compression="none")
        lines = [r.value for r in spark.read.text(path + "s/shard=a").collect()]
        assert " ".join(x.split("\t")[0] for x in lines if x[0] != "#") == want


def test_find_replace_is_a_regular_expression(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(vcf(["S1"], ["chr1\t1\tn.n\tA\tC\tnan\t.\tAC=1\tGT\t0/1"]))
    read = lambda a, b: SV.read_vcf(spark, str(tmp_path / "a.vcf"), find_replace=(a, b)).sites.first()
    assert read("nan", "7").qual == 7.0 and read("n.n", "7").rsid == "7" and read("n.n", "7").qual == 7.0
    assert read(r"n\.n", "7").rsid == "7" and read(r"n\.n", "7").qual != 7.0


def test_likelihoods_of_many_alleles(spark):
    """No number of genotypes is computed beyond the length of the array."""
    n, ploidy, a = 12, 3, 5
    order = sorted(combinations_with_replacement(range(n), ploidy), key=lambda g: g[::-1])
    pl = [(i * 37) % 101 for i in range(len(order))]
    df = spark.createDataFrame([(pl, a, n), (pl[:-1], a, n)], "PL array<int>, a_index int, num_alleles int")
    whole, odd = G.with_split_pl(df).collect()
    assert whole.PL == [min(x for x, g in zip(pl, order) if g.count(a) == c) for c in range(ploidy + 1)]
    assert odd.PL is None
