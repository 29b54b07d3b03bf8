"""Records that share a variant key, before or after the split, stay apart."""

import os

import pytest
from pyspark.sql import functions as F

from lociframe.operators import cohort as CO
from lociframe.operators import merge as MG
from lociframe.operators import sharding as SH
from lociframe.operators import split as SP
from lociframe.operators.intervals import region_overlap_filter
from lociframe.plans.annotate import annotate_sites
from lociframe.sinks import vcf as KV
from lociframe.sources import vcf as SV

HEAD = ['##INFO=<ID=AC,Number=A,Type=Integer,Description="c">', '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">',
        '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="d">']


def parsed(spark, records, samples=("S1", "S2")):
    head = [*HEAD, "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split() + list(samples))]
    lines = spark.createDataFrame([(x, i) for i, x in enumerate(head + records)], "value string, record long")
    return SV.parse_lines(spark, lines, head)


TWINS = ["chr1\t1\ta\tA\tC,G\t.\t.\tAC=1,2\tGT:AD\t0/1:3,4,5\t1/2:1,1,1", "chr1\t1\tb\tA\tC\t.\t.\tAC=9\tGT:AD\t1/1:0,8\t0/0:7,0"]


def test_split_genotypes_and_aggregates(spark):
    v = parsed(spark, TWINS)
    sites, calls = SP.split_multi(v.sites), SP.split_calls(v.calls)
    back = MG.add_genotypes(sites, v.calls).collect()
    assert len(back) == 6
    assert {(r.rsid, r.alleles[1], r.s): (r.GT.a1, r.GT.a2) for r in back}[("b", "C", "S1")] == (1, 1)
    out = CO.recompute_cohort_ac_af(sites, calls).collect()
    assert {(r.rsid, r.alleles[1]): r.info.cohort_AC for r in out} == {("a", "C"): 2, ("a", "G"): 1, ("b", "C"): 2}
    assert {r.rsid: r.info.DP for r in CO.info_depth(v.sites, v.calls).collect()} == {"a": 15, "b": 15}
    assert sorted((r.AC, r.AN) for r in CO.variant_qc(v.calls).collect()) == [([1, 2, 1], 4), ([2, 2], 4)]


def test_writers_keep_twins(spark, tmp_path):
    v = parsed(spark, TWINS)
    sites, calls = SP.split_multi(v.sites), SP.split_calls(v.calls)
    KV.write_vcf(spark, v.header, sites, str(tmp_path / "one"), calls=calls, samples=v.samples, compression="none")
    lines = [r.value for r in spark.read.text(str(tmp_path / "one")).collect() if not r.value.startswith("#")]
    assert sorted(x.split("\t")[2] + x.split("\t")[4] + x.split("\t")[9][:3] for x in lines) == ["aC0/1", "aG0/0", "bC1/1"]
    KV.write_vcf_shards(spark, v.header, SH.shard_by_records(sites, 1), "shard", str(tmp_path / "many"), calls=calls, samples=v.samples,
                        compression="none")
    shards = sorted(d for d in os.listdir(tmp_path / "many") if d.startswith("shard="))
    assert len(shards) == 3
    for d in shards:
        text = [x.value for x in spark.read.text(str(tmp_path / "many" / d)).collect()]
        assert len([x for x in text if not x.startswith("#")]) == 1 and any(x.startswith("#CHROM") for x in text)


def test_writer_fills_gaps_in_one_pass(spark):
    samples = [f"S{i}" for i in range(2000)]
    v = parsed(spark, ["chr1\t1\ta\tA\tC\t.\t.\tAC=1\tGT:AD\t" + "\t".join(["0/1:1,2"] * 2000), "chr1\t5\tb\tA\tC\t.\t.\tAC=1\tGT:AD\t" + "\t".join(["./.:."] * 2000)],
               samples)
    some = v.calls.where("position = 1 AND s IN ('S0', 'S3', 'S1999')")
    lines = {r.position: r.line.split("\t")[9:] for r in KV.record_lines(v.sites, some, v.samples).collect()}
    assert len(lines[1]) == len(lines[5]) == 2000 and set(lines[5]) == {"./.:."}
    assert [i for i, x in enumerate(lines[1]) if x == "0/1:1,2"] == [0, 3, 1999]


def test_merge_keeps_repeated_records_and_unlisted_samples(spark):
    a, b = parsed(spark, [TWINS[1], TWINS[1].replace("\tb\t", "\tc\t")]), parsed(spark, [TWINS[1]], ("S2", "T2"))
    sites, calls, _ = MG.merge_sample_sets([(a.sites, a.calls, a.samples.where("s = 'S1'")), (b.sites, b.calls, b.samples)])
    assert sites.count() == 2
    got = sorted((r.occurrence, r.s) for r in calls.select("occurrence", "s").collect())
    # S2 of the first file is not in its table: it keeps its name
    assert got == [(1, "S1"), (1, "S2"), (1, "S2"), (1, "T2"), (2, "S1"), (2, "S2")]


def test_backfill_decides_in_order(spark):
    rows = [(1, [5], [7, 8], None), (1, None, None, 3), (1, [None], None, 3)]
    df = spark.createDataFrame([(a, (x, y, z)) for a, x, y, z in rows], "a_index int, info struct<AS_QD:array<int>,AS_QD2_x:array<int>,QD:int>")
    out = CO.backfill_allele_specific(df)
    # one row misses AS_QD, one misses QD: not fewer, so nothing is replaced
    assert [r.info.QD for r in out.collect()] == [None, 3, 3]


def test_recount_without_calls_is_refused(spark):
    with pytest.raises(ValueError, match="needs the calls"):
        annotate_sites(parsed(spark, TWINS).sites, reannotate_ac_af=True)


def test_long_records_meet_regions_in_their_own_bins(spark):
    sites = spark.createDataFrame([("chr1", 9_990, ["A" * 25_000, "A"], 1), ("chr1", 100, ["A", "C"], 2), ("chr1", 34_991, ["A", "C"], 3)],
                                  "contig string, position long, alleles array<string>, id int")
    regions = spark.createDataFrame([("chr1", 34_980, 34_985, "x"), ("chr1", 20_000, 20_001, "y")], "contig string, start0 long, end0 long, target string")
    assert [r.id for r in region_overlap_filter(sites, regions).collect()] == [1]


def test_row_numbers_need_no_checkpoint(spark):
    df = spark.createDataFrame([(i * 7919 % 1009, i) for i in range(1000)], "k long, v long").repartition(7)
    ranked = SH.row_number_by(df, "k", "v")
    assert [r.rn for r in ranked.orderBy("k", "v").collect()] == list(range(1, 1001))
    text = spark.createDataFrame([(None,), ("b",), ("a",), ("b",)], "k string")
    assert sorted((r.k or "", r.rn) for r in SH.row_number_by(text, F.col("k")).collect()) == [("", 1), ("a", 2), ("b", 3), ("b", 4)]
    assert SH.row_number_by(text.limit(0), "k").count() == 0
