"""VCF / BED text in and out, on small hand-written files."""

import gzip
import os

from pyspark.sql import functions as F

from lociframe.operators import header as HD
from lociframe.sinks import vcf as KV
from lociframe.sources import tables as TB
from lociframe.sources import vcf as SV

VCF = """##fileformat=VCFv4.2
##FILTER=<ID=PASS,Description="All filters passed">
##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">
##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">
##INFO=<ID=VQSLOD,Number=1,Type=Float,Description="Log odds">
##INFO=<ID=DB,Number=0,Type=Flag,Description="In dbSNP">
##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: SYMBOL|Feature|Consequence">
##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">
##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths">
##FORMAT=<ID=DP,Number=1,Type=Integer,Description="Depth">
##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">
##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Likelihoods">
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
chr1\t100\trs1\tA\tC,*\t50\tPASS\tAC=1,1;AF=0.25,0.25;VQSLOD=nan;DB;CSQ=G1|T1|a&b,G2|T2|c\tGT:AD:DP:GQ:PL\t0/1:5,3,0:8:30:0,10,20,30,40,50\t1/2:.:.:20:.
chr1\t200\t.\tCAGT\tCA,CAGTT\t.\tPASS\tAC=1,2;AF=0.1,0.2\tGT:AD:GQ\t0|2:1,2,3:40\t./.
chrY\t300\t.\tG\tT\t.\t.\tAC=1;AF=1.0;CSQ=junk\tGT\t1\t0
"""


def _write(tmp_path, name, data: bytes):
    d = tmp_path / name.replace(".", "_")
    d.mkdir()
    p = d / name
    p.write_bytes(data)
    return str(p)


def _check(v):
    sites = {r.position: r for r in v.sites.collect()}
    assert set(sites) == {100, 200, 300}
    s1 = sites[100]
    assert s1.rsid == "rs1" and s1.qual == 50.0 and list(s1.filters) == ["PASS"]
    assert list(s1.alleles) == ["A", "C", "*"] and list(s1.info.AC) == [1, 1] and s1.info.DB is True
    assert sites[200].info.DB is False and sites[200].rsid is None and sites[300].filters is None
    assert list(s1.info.CSQ) == ["G1|T1|a&b", "G2|T2|c"]
    calls = {(r.position, r.s): r for r in v.calls.collect()}
    assert len(calls) == 6
    c = calls[(100, "S1")]
    assert (c.GT.a1, c.GT.a2, c.GT.phased) == (0, 1, False) and list(c.AD) == [5, 3, 0] and c.DP == 8
    assert list(c.PL) == [0, 10, 20, 30, 40, 50]
    c = calls[(100, "S2")]
    assert (c.GT.a1, c.GT.a2) == (1, 2) and c.AD is None and c.DP is None and c.GQ == 20 and c.PL is None
    c = calls[(200, "S1")]
    assert c.GT.phased is True and c.GQ == 40 and c.DP is None
    assert calls[(200, "S2")].GT is None
    c = calls[(300, "S1")]
    assert c.GT.a1 == 1 and c.GT.a2 is None


def test_read_plain_gz_bgz(spark, tmp_path):
    data = VCF.encode()
    half = data.index(b"chr1\t200")
    plain = _write(tmp_path, "x.vcf", data)
    multi = gzip.compress(data[:half]) + gzip.compress(data[half:])  # two gzip members
    gz = _write(tmp_path, "x.vcf.gz", multi)
    bgz = _write(tmp_path, "x.vcf.bgz", multi)
    for p in (plain, gz, bgz):
        v = SV.read_vcf(spark, p, find_replace=("nan", "."))
        assert v.header.samples == ["S1", "S2"]
        _check(v)
        assert [r.info.VQSLOD for r in v.sites.where("position = 100").collect()] == [None]


def test_sites_only_and_header_frame(spark, tmp_path):
    p = _write(tmp_path, "y.vcf", VCF.encode())
    v = SV.read_vcf(spark, p, drop_samples=True)
    assert v.calls is None and v.sites.count() == 3
    h = SV.header_frame(spark, v.header)
    rows = {(r.section, r.id): r for r in h.collect()}
    assert rows[("INFO", "AC")].number == "A" and rows[("FORMAT", "PL")].type == "Integer"
    assert SV.samples_frame(spark, v.header).orderBy("ordinal").collect()[1].s == "S2"


def test_write_then_read_back(spark, tmp_path):
    p = _write(tmp_path, "z.vcf", VCF.encode())
    v = SV.read_vcf(spark, p, find_replace=("nan", "."))
    out = str(tmp_path / "out_vcf")
    KV.write_vcf(spark, v.header, v.sites, out, calls=v.calls, samples=v.samples)
    back = SV.read_vcf(spark, out, find_replace=("nan", "."))
    _check(back)
    first = sorted(f for f in os.listdir(out) if f.startswith("part-"))[0]
    with gzip.open(os.path.join(out, first), "rt") as fh:
        assert fh.readline().startswith("##fileformat")


def test_write_shards_header_in_each_and_nothing_when_empty(spark, tmp_path):
    p = _write(tmp_path, "w.vcf", VCF.encode())
    v = SV.read_vcf(spark, p, drop_samples=True)
    sites = v.sites.withColumn("shard", F.col("contig"))
    out = str(tmp_path / "shards")
    assert KV.write_vcf_shards(spark, v.header, sites, "shard", out, compression="none")
    dirs = sorted(d for d in os.listdir(out) if d.startswith("shard="))
    assert dirs == ["shard=chr1", "shard=chrY"]
    for d in dirs:
        text = "".join(open(os.path.join(out, d, f)).read() for f in sorted(os.listdir(os.path.join(out, d)))
                       if f.startswith("part-"))
        assert text.startswith("##fileformat") and "#CHROM" in text
    empty = str(tmp_path / "none")
    assert not KV.write_vcf_shards(spark, v.header, sites.where("false"), "shard", empty)
    assert not os.path.exists(empty)


def test_bed_with_and_without_header(spark, tmp_path):
    body = "chr1\t10\t20\tA\nchr1\t30\t25\tbad\nchrUn\t1\t5\tX\nchr2\t0\t5\tB\n"
    with_h = _write(tmp_path, "a.bed", ("chrom\tstart\tend\tname\n" + body).encode())
    without = _write(tmp_path, "b.bed", body.encode())
    for p in (with_h, without):
        got = sorted(tuple(r) for r in TB.read_bed(spark, p, build="GRCh38").collect())
        assert got == [("chr1", 10, 20, "A"), ("chr2", 0, 5, "B")]


def test_header_edits():
    h = SV.parse_header_lines(VCF.splitlines())
    h2 = HD.set_field(h, "INFO", "REVEL", ".", "String", "REVEL scores.")
    assert "REVEL" in h2.info and "REVEL" not in h.info
    h3 = HD.append_filter_lines(h2, ['##FILTER=<ID=PASS,Description="other">',
                                     '##FILTER=<ID=LowDP,Description="Low depth">'])
    assert h3.filter["PASS"]["Description"] == "All filters passed" and "LowDP" in h3.filter
    h4 = HD.add_merge_filters(h3)
    assert {"LowQual", "NO_HQ_GENOTYPES"} <= set(h4.filter)
    lines = KV.header_lines(h4)
    assert any(x.startswith("##FILTER=<ID=NO_HQ_GENOTYPES") for x in lines) and lines[-1].startswith("#CHROM")


def test_extra_header():
    from lociframe.plans.extra import extra_header
    h = SV.parse_header_lines(VCF.splitlines())
    h2 = extra_header(h, "Format: SYMBOL|Feature|Consequence|LOEUF_v2", with_intervals=True)
    assert h2.info["CSQ"]["Description"].endswith("|LOEUF_v2") and h2.info["REVEL"]["Type"] == "String"
    assert "PREDICTED_NONCODING" in h2.info and "PREDICTED_NONCODING" not in h.info


def test_shard_by_records_then_write_and_read_each_shard(spark, tmp_path):
    from lociframe.operators.sharding import shard_by_records
    p = _write(tmp_path, "s.vcf", VCF.encode())
    v = SV.read_vcf(spark, p)
    sites = shard_by_records(v.sites, 2)          # 3 records -> shards 0 (2 records) and 1 (1 record)
    out = str(tmp_path / "by_records")
    assert KV.write_vcf_shards(spark, v.header, sites, "shard", out, calls=v.calls, samples=v.samples)
    shards = sorted(d for d in os.listdir(out) if d.startswith("shard="))
    assert shards == ["shard=0", "shard=1"]
    counts = {}
    for d in shards:
        back = SV.read_vcf(spark, os.path.join(out, d))
        assert back.header.samples == ["S1", "S2"]
        counts[d] = (back.sites.count(), back.calls.count())
    assert counts == {"shard=0": (2, 4), "shard=1": (1, 2)}
