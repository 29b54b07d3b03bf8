"""Hand-written cases for the semantics that must not be lost."""

from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.operators import cohort as CO
from lociframe.operators import packed as PK
from lociframe.operators.lookup import lookup
from lociframe.operators.split import split_calls, split_multi

SITES_SCHEMA = "contig string, position long, alleles array<string>"


def _split(spark, rows):
    df = spark.createDataFrame(rows, SITES_SCHEMA)
    out = split_multi(df).select("position", F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"),
                                 "a_index", "was_split", "num_alleles")
    return sorted(tuple(r) for r in out.collect())


def test_biallelic_rows_pass_unchanged(spark):
    # a bi-allelic pair with a common suffix is NOT trimmed
    assert _split(spark, [("chr1", 100, ["GT", "GTT"])]) == [(100, "GT", "GTT", 1, False, 2)]


def test_minimal_representation_moves_position(spark):
    # CAGT -> CA,CAGTT : suffix first (CAG/C... and CAG/CAGT), then prefix:
    # alt1 AGT>A at +1 ; alt2 G>GT at +2 (left-aligned)
    got = _split(spark, [("chr1", 100, ["CAGT", "CA", "CAGTT"])])
    assert got == [(101, "AGT", "A", 1, True, 3), (102, "G", "GT", 2, True, 3)]


def test_star_allele_dropped_only_when_split(spark):
    got = _split(spark, [("chr1", 10, ["A", "C", "*"]), ("chr1", 20, ["A", "*"])])
    assert got == [(10, "A", "C", 1, True, 3), (20, "A", "*", 1, False, 2)]


def test_suffix_trim_keeps_one_base(spark):
    # GA -> A,GAA : suffix A is common but GA/A keeps one base each
    got = _split(spark, [("chr1", 5, ["GA", "A", "GAA"])])
    assert got == sorted([(5, "GA", "A", 1, True, 3), (5, "G", "GA", 2, True, 3)])


def test_single_allele_record_drops_out(spark):
    assert _split(spark, [("chr1", 5, ["A"])]) == []


def _calls(spark, a1, a2, ad, pl, alleles=("A", "C", "G", "T")):
    return spark.createDataFrame(
        [("chr1", 1, list(alleles), "S1", (a1, a2, False), ad, pl)],
        "contig string, position long, alleles array<string>, s string, "
        "GT struct<a1:int,a2:int,phased:boolean>, AD array<int>, PL array<int>")


def test_downcode_gt_ad_pl(spark):
    pl = list(range(10, 20))  # 3 alts: genotypes 00,01,11,02,12,22,03,13,23,33
    out = split_calls(_calls(spark, 2, 3, [5, 6, 7, 8], pl)).orderBy("a_index").collect()
    gts = [(r.GT.a1, r.GT.a2) for r in out]
    assert gts == [(0, 0), (0, 1), (0, 1)]  # 2/3 at a=1 -> 0/0, at a=2 -> 0/1, at a=3 -> 0/1
    assert [list(r.AD) for r in out] == [[20, 6], [19, 7], [18, 8]]
    # a=2: class2 = PL[5]=15; class1 = min(PL[3],PL[4],PL[8])=13; class0 = min of rest = 10
    assert list(out[1].PL) == [10, 13, 15]


def test_split_missing_entries_stay_missing(spark):
    out = split_calls(_calls(spark, None, None, None, None, ("A", "C"))).collect()[0]
    assert out.GT is None and out.AD is None and out.PL is None


def test_estimated_pl(spark):
    rows = [((0, 0, False), 30, [10, 2]), ((0, 1, False), 30, [10, 2]), ((1, 1, False), 30, [2, 10]),
            (None, 30, [1, 1]), ((0, 0, False), 5, None)]
    df = spark.createDataFrame(rows, "GT struct<a1:int,a2:int,phased:boolean>, GQ int, AD array<int>")
    got = [r.PL for r in df.select(G.estimated_pl(F.col("GT"), F.col("GQ"), F.col("AD")).alias("PL")).collect()]
    assert got[0] == [0, 30, 30] and got[1] == [30, 0, 30] and got[2] == [30, 30, 0]
    assert got[3] is None
    assert got[4] == [0, 5, 5]  # greatest ignores the missing AD term


def test_haploid_to_diploid(spark):
    df = spark.createDataFrame([((1, None, False),), ((None, None, False),)], "GT struct<a1:int,a2:int,phased:boolean>")
    got = [r.GT for r in df.select(G.haploid_to_diploid(F.col("GT")).alias("GT")).collect()]
    assert (got[0].a1, got[0].a2) == (1, 1) and got[1].a1 is None


def test_parse_entries_no_pipe_and_trailing_empties(spark):
    fields = ["SYMBOL", "Feature", "Consequence", "HGVSc", "HGVSp"]
    df = spark.createDataFrame([(["G1|T1|a&b||", "junk"],)], "CSQ array<string>")
    tc = df.select(PK.parse_entries(F.col("CSQ"), fields).alias("tc")).first().tc
    assert tc[0].SYMBOL == "G1" and list(tc[0].Consequence) == ["a", "b"] and tc[0].HGVSc == "" and tc[0].HGVSp == ""
    assert tc[1].SYMBOL is None and list(tc[1].Consequence) == [None]


def test_pack_is_inverse_of_parse(spark):
    fields = ["SYMBOL", "Feature", "Consequence"]
    packed = ["G1|T1|a&b", "G2|T2|c", "G3||"]
    df = spark.createDataFrame([("chr1", 1, ["A", "C"], packed)], SITES_SCHEMA + ", CSQ array<string>")
    e = PK.explode_packed(df, F.col("CSQ"), fields)
    out = PK.regroup(e, fields).first().CSQ
    assert out == ",".join(packed)


def test_hgvsc_symbol_skips_missing(spark):
    df = spark.createDataFrame([("G", "ENST1:c.1A>G", ""), ("", "", "ENSP:p.X")], "s string, c string, p string")
    got = [r[0] for r in df.select(PK.hgvsc_symbol(F.col("s"), F.col("c"), F.col("p"))).collect()]
    assert got == ["G, c.1A>G", ", p.X"]


def test_lookup_never_multiplies_and_matched_null_stays_null(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", None)], "key string, v string")
    out = lookup(left, right, {"key": F.col("k")}, {"v": "v"}, default="")
    got = dict((r.k, r.v) for r in out.collect())
    assert out.count() == 3
    assert got == {"a": "1", "b": None, "c": ""}


def test_backfill_fires_only_with_fewer_missing(spark):
    schema = "contig string, position long, alleles array<string>, a_index int, info struct<VQSLOD:double, AS_VQSLOD:array<double>>"
    rows = [("chr1", 1, ["A", "C"], 1, (None, [1.5])), ("chr1", 2, ["A", "C"], 1, (2.0, [3.5]))]
    df = spark.createDataFrame(rows, schema)
    got = [r.v for r in CO.backfill_allele_specific(df).select(F.col("info.VQSLOD").alias("v")).orderBy("position").collect()]
    assert got == [1.5, 3.5]
    rows2 = [("chr1", 1, ["A", "C"], 1, (1.0, None)), ("chr1", 2, ["A", "C"], 1, (2.0, [3.5]))]
    got2 = [r.v for r in CO.backfill_allele_specific(spark.createDataFrame(rows2, schema))
            .select(F.col("info.VQSLOD").alias("v")).orderBy("position").collect()]
    assert got2 == [1.0, 2.0]


def test_info_depth_zero_without_ad(spark):
    sites = spark.createDataFrame([("chr1", 1, ["A", "C"], (1,))], SITES_SCHEMA + ", info struct<x:int>")
    calls = spark.createDataFrame([("chr1", 1, ["A", "C"], "S1", None)],
                                  SITES_SCHEMA + ", s string, AD array<int>")
    assert CO.info_depth(sites, calls).first().info.DP == 0


def test_interval_label_nested_adjacent_and_ties(spark):
    from lociframe.operators.intervals import interval_label, interval_filter
    iv = spark.createDataFrame([("chr1", 10, 20, "a"), ("chr1", 20, 30, "b"), ("chr1", 0, 100, "wide"),
                                ("chr1", 15, 25, "mid"), ("chr2", 5, 6, "one")],
                               "contig string, start0 long, end0 long, target string")
    pos = [("chr1", p, ["A", "C"]) for p in (5, 10, 11, 16, 20, 21, 26, 100, 101)] + [("chr2", 6, ["A", "C"]),
                                                                                   ("chr2", 5, ["A", "C"])]
    sites = spark.createDataFrame(pos, SITES_SCHEMA)
    got = {(r.contig, r.position): r.PREDICTED_NONCODING
           for r in interval_label(sites, iv, width=7, into_info=False).collect()}
    # smallest (start0, end0, target) among containing intervals; 1-based p in (start0, end0]
    assert got == {("chr1", 5): "wide", ("chr1", 10): "wide", ("chr1", 11): "wide", ("chr1", 16): "wide",
                   ("chr1", 20): "wide", ("chr1", 21): "wide", ("chr1", 26): "wide", ("chr1", 100): "wide",
                   ("chr1", 101): None, ("chr2", 6): "one", ("chr2", 5): None}
    narrow = iv.where("target <> 'wide'")
    got2 = {r.position: r.PREDICTED_NONCODING
            for r in interval_label(sites.where("contig = 'chr1'"), narrow, width=7, into_info=False).collect()}
    assert got2 == {5: None, 10: None, 11: "a", 16: "a", 20: "a", 21: "mid", 26: "b", 100: None, 101: None}
    kept = sorted(r.position for r in interval_filter(sites.where("contig = 'chr1'"), narrow, width=7).collect())
    assert kept == [11, 16, 20, 21, 26]


def test_stored_unique_lookup_table(spark, tmp_path):
    from lociframe.operators.lookup import store_keyed, lookup_by_variant
    t = spark.createDataFrame([("chr1", 1, ["A", "C"], 0.5), ("chr1", 1, ["A", "C"], 0.2), ("chr1", 2, ["G", "T"], 0.9)],
                              "contig string, position long, alleles array<string>, mpc double")
    path = str(tmp_path / "mpc")
    store_keyed(t, ["contig", "position", "alleles"], ["mpc"], path, partitions=2)
    stored = spark.read.parquet(path)
    sites = spark.createDataFrame([("chr1", 1, ["A", "C"]), ("chr1", 3, ["A", "C"])], SITES_SCHEMA)
    got = {r.position: r.MPC for r in lookup_by_variant(sites, stored, {"MPC": "mpc"}, unique_keys=True).collect()}
    assert got == {1: 0.2, 3: None}


def test_loeuf_default_only_for_absent_transcripts(spark):
    fields = ["SYMBOL", "Feature", "Consequence"]
    df = spark.createDataFrame([("chr1", 1, ["A", "C"], ["G1|T1|x", "G2|T2|y", "G3|T3|z"])],
                               SITES_SCHEMA + ", CSQ array<string>")
    e = PK.explode_packed(df, F.col("CSQ"), fields)
    v2 = spark.createDataFrame([("T1", "0.3", "2"), ("T2", None, None)],
                               "transcript string, oe_lof_upper string, oe_lof_upper_bin string")
    v4 = spark.createDataFrame([("T1", "0.5", "4")],
                               "transcript string, `lof.oe_ci.upper` string, `lof.oe_ci.upper_bin_decile` string")
    got = {r.t_Feature: (r.t_LOEUF_v2, r.t_LOEUF_v4) for r in PK.loeuf(e, v2, v4).collect()}
    assert got == {"T1": ("0.3", "0.5"), "T2": (None, ""), "T3": ("", "")}
