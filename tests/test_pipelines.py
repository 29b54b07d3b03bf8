"""Hook, model, streaming, sharding invariants and table sinks."""

import os

import pandas as pd
from pyspark.sql import functions as F

from lociframe.operators import ancestry as AN
from lociframe.operators import merge as MG
from lociframe.operators import sharding as SH
from lociframe.plans import annotate as AT
from lociframe.sinks import tables as KT
from lociframe.sources import tables as TB
from lociframe.sources import vcf as SV
from lociframe.streaming import shards as ST

SCHEMA = "contig string, position long, alleles array<string>, info struct<x:int>"


def test_annotator_hook_tolerates_failures(spark):
    sites = spark.createDataFrame([("chr1", i, ["A", "C" if i != 3 else "BAD"], (i,)) for i in range(1, 6)], SCHEMA)

    def annotator(batch: pd.DataFrame) -> pd.Series:
        if (batch["alt"] == "BAD").any():
            raise ValueError("cannot parse")
        return pd.Series([[f"{r.ref}>{r.alt}"] for r in batch.itertuples()])

    out = {r.position: r.info.CSQ for r in AT.annotate_with(sites, annotator).collect()}
    assert out[1] == ["A>C"] and out[3] is None and len(out) == 5


def test_population_model_save_and_load(spark, tmp_path):
    rows = [(f"s{i}", [float(i % 3), float(i % 3) * 2.0, 1.0], f"p{i % 3}" if i % 4 else None) for i in range(60)]
    scores = spark.createDataFrame(rows, "s string, scores array<double>, known_pop string")
    out, model = AN.assign_population(scores, num_pcs=3, min_prob=0.5, num_trees=10, return_model=True)
    assert out.count() == 60 and {"pop", "prob_p0", "prob_p1", "prob_p2"} <= set(out.columns)
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = AN.apply_population_model(scores, AN.load_population_model(path), min_prob=0.5, num_pcs=3)
    a = {r.s: r.pop for r in out.collect()}
    b = {r.s: r.pop for r in again.collect()}
    assert a == b


def test_streaming_split_of_arriving_shards(spark, tmp_path):
    from tests.test_io import VCF
    src = tmp_path / "incoming"
    src.mkdir()
    (src / "shard_1.vcf").write_text(VCF)
    header = SV.parse_header_lines(VCF.splitlines())
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = ST.start_split_sites(spark, str(src), header, out, ck, once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    # chr1:100 splits into one row (star dropped), chr1:200 into two, chrY one
    assert got.count() == 4 and "cohort_AC" in got.schema["info"].dataType.fieldNames()


def test_every_row_in_exactly_one_shard_of_bounded_size(spark):
    rows = [(f"chr{1 + i % 3}", 1000 + i * 7, ["A", "C"], (i,)) for i in range(250)]
    sites = spark.createDataFrame(rows, SCHEMA)
    sh = SH.shard_by_records(sites, 40)
    sizes = [r["count"] for r in sh.groupBy("shard").count().collect()]
    assert sum(sizes) == 250 and max(sizes) <= 40 and len(sizes) == 7
    rn = sorted(r.rn for r in sh.select("rn").collect())
    assert rn == list(range(1, 251))
    by_contig = SH.shard_by_contig(sites, "GRCh38", 30)
    assert by_contig.select("shard").distinct().count() == 9


def test_pairs_of_chunks(spark):
    samples = spark.createDataFrame([(f"x{i:02d}",) for i in range(10)], "s string")
    out = SH.sample_chunk_pairs(samples, 4)  # chunks of 4,4,2 -> pairs (0,1),(0,2),(1,2)
    sizes = {r.shard: r["count"] for r in out.groupBy("shard").count().collect()}
    assert sizes == {0: 8, 1: 6, 2: 6}
    one = SH.sample_chunk_pairs(samples, 20)
    assert one.count() == 0


def test_version_sort_and_tables(spark, tmp_path):
    assert MG.version_sorted(["a/shard_10.vcf", "b/shard_2.vcf", "c/shard_1.vcf"]) == \
        ["c/shard_1.vcf", "b/shard_2.vcf", "a/shard_10.vcf"]
    ped = tmp_path / "p.ped"
    ped.write_text("fam\tid\tdad\tmom\tsex\tpheno\textra\nF1\tA\t0\t0\t1\t2\tz\n")
    p = TB.read_pedigree(spark, str(ped))
    assert p.columns == TB.PEDIGREE_COLUMNS and p.first().sample_id == "A"
    sites = spark.createDataFrame([("chr1", 1, ["A", "C"], (1,))], SCHEMA)
    KT.write_matrix_table(sites, None, str(tmp_path / "mt"))
    s2, _ = TB.read_matrix_table(spark, str(tmp_path / "mt")) if os.path.exists(str(tmp_path / "mt/calls")) \
        else (spark.read.parquet(str(tmp_path / "mt/sites")), None)
    assert s2.count() == 1
    KT.write_tsv(p, str(tmp_path / "tsv"))
    assert TB.read_tsv(spark, str(tmp_path / "tsv")).count() == 1
    members = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "chunk long, s string")
    KT.write_chunk_lists(members, "chunk", "s", str(tmp_path / "chunks"))
    assert sorted(d for d in os.listdir(tmp_path / "chunks") if d.startswith("chunk=")) == ["chunk=0", "chunk=1"]


def test_callset_plans(spark, tmp_path):
    from tests.test_io import VCF
    from lociframe.plans import callsets as CS
    p = tmp_path / "in.vcf"
    p.write_text(VCF)
    v = SV.read_vcf(spark, str(p), find_replace=("nan", "."))
    d = CS.add_depth(v, with_pl=True)
    dp = {r.position: r.info.DP for r in d.sites.collect()}
    assert dp[100] == 8 and dp[200] == 6 and dp[300] == 0
    pl = {(r.position, r.s): r.PL for r in d.calls.collect()}
    # het 0/1 with GQ 30, AD 5,3 -> m = max(30, 6) ; haploid 1 -> 1/1 without GQ/AD
    assert pl[(100, "S1")] == [30, 0, 30] and pl[(300, "S1")] == [None, None, 0]
    assert "PL" in d.header.format and d.header.info["DP"]["Type"] == "Integer"
    per, total = CS.count_variants(v.sites, "contig")
    t = total.first()
    # A>C,* : the ALT field "C,*" differs in length from REF -> counted as indel
    assert (t.n_records, t.n_snv, t.n_indel) == (3, 1, 2)
    m = CS.merge_callsets([v, v])
    names = [r.s for r in m.samples.orderBy("ordinal").collect()]
    assert names == ["S1", "S2", "2:S1", "2:S2"]
    assert m.calls.count() == 12 and m.sites.count() == 3 and "NO_HQ_GENOTYPES" in m.header.filter
    out = str(tmp_path / "merged")
    CS.callset_to_vcf(spark, m.header, m.sites, m.calls, m.samples, out)
    back = SV.read_vcf(spark, out)
    assert back.header.samples == names and back.calls.count() == 12


def test_ancestry_plan_and_list_readers(spark, tmp_path):
    from lociframe.plans import callsets as CS
    from lociframe.plans import inputs as IN
    from lociframe.plans import queries as Q
    from lociframe.plans.fixtures import fixture
    sf = "/root/testdata/sf0.001"
    s = IN.sites(spark, sf)
    calls = IN.calls(spark, sf)
    ld = Q._loadings(spark, sf, s)
    cohort = calls.where("vid % 3 <> 0").withColumn("s", F.concat(F.lit("C"), F.substring("s", 2, 8)))
    out = CS.infer_ancestry(s.where("vid % 3 <> 0"), cohort, s, calls, ld, fixture(spark, sf, "fx_pop_labels"),
                            num_pcs=8, min_prob=0.5)
    rows = out.collect()
    assert {r.s[0] for r in rows} == {"C", "S"} and all(r.pop for r in rows)
    assert {r.known_pop for r in rows if r.s.startswith("S")} == {"afr", "nfe", "sas", "eas", "amr"}
    CS.write_ancestry_tsv(out, str(tmp_path / "anc"))
    back = TB.read_tsv(spark, str(tmp_path / "anc"))
    assert back.count() == len(rows) and back.first().pca_scores.startswith("[")
    genes = tmp_path / "my_genes.txt"
    genes.write_text("GENE1\tx\nGENE2\n\n")
    lst = TB.read_list(spark, str(genes), "symbol")
    assert sorted(r.symbol for r in lst.collect()) == ["GENE1", "GENE2"]
    assert TB.list_name(str(genes)) == "my_genes.txt"


def test_parse_lines_from_dataframe(spark):
    from tests.test_io import VCF
    lines = spark.createDataFrame([(x,) for x in VCF.splitlines() if not x.startswith("#")], "value string")
    head = [x for x in VCF.splitlines() if x.startswith("#")]
    v = SV.parse_lines(spark, lines, head)
    assert v.sites.count() == 3 and v.calls.count() == 6


def test_classifier_accuracy_floor(spark):
    import numpy as np
    from lociframe.operators import ancestry as AN
    from lociframe.plans.queries import _labelled_scores
    out = AN.assign_population(_labelled_scores(spark, "/root/testdata/sf0.01"), num_pcs=16, min_prob=0.75)
    probs = [c for c in out.columns if c.startswith("prob_")]
    pdf = out.select("known_pop", "pop", *probs).toPandas()
    assert len(pdf) == 500
    p = pdf[probs].values
    best = np.array([c[5:] for c in probs])[p.argmax(1)]
    known = pdf.known_pop.notna().values
    # the forest fits its training labels (argmax), and a label is only
    # assigned when its probability reaches min_prob (0.75), else "oth"
    assert (best[known] == pdf.known_pop.values[known]).mean() >= 0.6
    expect = np.where(p.max(1) >= 0.75, best, "oth")
    assert (pdf["pop"].values == expect).all()


def test_streaming_enrichment_with_static_tables(spark, tmp_path):
    from tests.test_io import VCF
    src = tmp_path / "in2"
    src.mkdir()
    (src / "shard_a.vcf").write_text(VCF)
    header = SV.parse_header_lines(VCF.splitlines())
    # chr1:200 CAGT>CA splits to AGT>A at 201
    mpc = spark.createDataFrame([("chr1", 201, ["AGT", "A"], 0.7), ("chr1", 201, ["AGT", "A"], 0.9)],
                                "contig string, position long, alleles array<string>, mpc double")
    iv = spark.createDataFrame([("chr1", 150, 250, "enh")], "contig string, start0 long, end0 long, target string")
    out, ck = str(tmp_path / "out2"), str(tmp_path / "ck2")
    q = ST.start_annotated_sites(spark, str(src), header, out, ck, scores=[(mpc, {"MPC": "mpc"})],
                                 intervals=iv, once=True)
    q.awaitTermination(120)
    rows = {(r.position, r.alleles[1]): r.info for r in spark.read.parquet(out).collect()}
    assert rows[(201, "A")].MPC == 0.7 and rows[(201, "A")].PREDICTED_NONCODING == "enh"
    assert rows[(100, "C")].MPC is None and rows[(100, "C")].PREDICTED_NONCODING is None


def test_add_hgvsc_symbol_plan(spark):
    from lociframe.plans.annotate import add_hgvsc_symbol
    desc = "Consequence annotations. Format: SYMBOL|Feature|HGVSc|HGVSp"
    sites = spark.createDataFrame(
        [("chr1", 1, ["A", "C"], (["G1|T1|T1:c.1A>C|P1:p.K1N", "G2|T2||"],)), ("chr1", 2, ["A", "G"], (None,))],
        "contig string, position long, alleles array<string>, info struct<CSQ:array<string>>")
    out, d = add_hgvsc_symbol(sites, desc)
    got = {r.position: r.info.CSQ for r in out.collect()}
    assert got[1] == ["G1|T1|T1:c.1A>C|P1:p.K1N|G1, c.1A>C, p.K1N", "G2|T2|||G2"] and got[2] is None
    assert d == "Format: SYMBOL|Feature|HGVSc|HGVSp|HGVSc_symbol"


def test_get_spark_keeps_existing_session_settings(spark):
    from lociframe.session import get_spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1234567")
    same = get_spark("local[2]", shuffle_partitions=3)
    assert same is spark
    assert same.conf.get("spark.sql.shuffle.partitions") == before
    assert same.conf.get("spark.sql.autoBroadcastJoinThreshold") == "1234567"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert same.sparkContext.getCheckpointDir()
