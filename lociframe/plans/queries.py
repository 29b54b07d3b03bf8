"""Registered queries: one per starred operator of the blueprint.

Each Spark query takes ``(spark, sf_dir)`` and returns a DataFrame of scalar
columns; ``ORACLES`` holds an independently written DuckDB statement with
the same column names over the same driver tables (fixtures as CTEs).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.operators import split as SP
from lociframe.operators import cohort as CO
from lociframe.plans import inputs as IN
from lociframe.plans.fixtures import cte
from lociframe.sinks import vcf as KV

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _split_out(df: DataFrame) -> DataFrame:
    return df.select("vid", "a_index", "num_alleles", "was_split", "contig", "position",
                     F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"))


# ---------------------------------------------------------------- oracle parts
# DuckDB: alleles unnested with their index, then the minimal representation
# by counting matching suffix / prefix lengths over a number table.
_SPLIT_SQL = """
nums AS (SELECT unnest(range(1, greatest(m, 2))) AS k FROM (SELECT max(greatest(length(ref), length(alts))) AS m FROM fx_sites)),
a0 AS (
  SELECT vid, contig, position, ref, unnest(string_split(alts, ',')) AS alt,
         generate_subscripts(string_split(alts, ','), 1) AS a_index,
         len(string_split(alts, ',')) + 1 AS num_alleles
  FROM fx_sites),
a1 AS (SELECT *, num_alleles > 2 AS was_split FROM a0 WHERE NOT (num_alleles > 2 AND alt = '*')),
sfx AS (
  SELECT a1.vid, a1.a_index, count(r.k) AS n
  FROM a1, nums r
  WHERE a1.was_split AND r.k < least(length(a1.ref), length(a1.alt)) AND right(a1.ref, CAST(r.k AS INT)) = right(a1.alt, CAST(r.k AS INT))
  GROUP BY a1.vid, a1.a_index),
a2 AS (
  SELECT a1.*, left(a1.ref, CAST(length(a1.ref) - coalesce(sfx.n, 0) AS INT)) AS ref1,
         left(a1.alt, CAST(length(a1.alt) - coalesce(sfx.n, 0) AS INT)) AS alt1
  FROM a1 LEFT JOIN sfx ON a1.vid = sfx.vid AND a1.a_index = sfx.a_index),
pfx AS (
  SELECT a2.vid, a2.a_index, count(r.k) AS n
  FROM a2, nums r
  WHERE a2.was_split AND r.k < least(length(a2.ref1), length(a2.alt1)) AND left(a2.ref1, CAST(r.k AS INT)) = left(a2.alt1, CAST(r.k AS INT))
  GROUP BY a2.vid, a2.a_index),
split AS MATERIALIZED (
  SELECT a2.vid, CAST(a2.a_index AS INT) AS a_index, CAST(a2.num_alleles AS INT) AS num_alleles, a2.was_split, a2.contig,
         CAST(a2.position + coalesce(pfx.n, 0) AS BIGINT) AS position,
         substr(a2.ref1, CAST(coalesce(pfx.n, 0) + 1 AS INT)) AS ref,
         substr(a2.alt1, CAST(coalesce(pfx.n, 0) + 1 AS INT)) AS alt
  FROM a2 LEFT JOIN pfx ON a2.vid = pfx.vid AND a2.a_index = pfx.a_index)
"""


def _with(*fixtures: str) -> str:
    return cte(*fixtures).rstrip() + ",\n"


def _twins(sql: str) -> str:
    """An oracle part over the tables with twin records."""
    return re.sub(r"\bfx_(sites|calls)\b", r"fx_\1_t", sql)


# ------------------------------------------------------------------ R1 / F1 / U1
@query("split_sites", _with("fx_sites") + _SPLIT_SQL + """
SELECT vid, a_index, num_alleles, was_split, contig, position, ref, alt FROM split""")
def q_split_sites(spark, sf):
    return _split_out(SP.split_multi(IN.sites(spark, sf)))


# ------------------------------------------------------------------ R1a-c
_CALLS_SQL = """
c0 AS (
  SELECT c.vid, c.s, c.a1, c.a2, c.nalt, c.pl_seed,
         CASE WHEN c.ad0 IS NULL THEN NULL ELSE coalesce(c.ad0, 0) + coalesce(c.ad1, 0) + coalesce(c.ad2, 0) + coalesce(c.ad3, 0) END AS ad_total,
         c.ad0, c.ad1, c.ad2, c.ad3
  FROM fx_calls c),
cs AS MATERIALIZED (
  SELECT sp.vid, sp.a_index, c0.s,
         CASE WHEN c0.a1 IS NULL THEN NULL ELSE least(CAST(c0.a1 = sp.a_index AS INT), coalesce(CAST(c0.a2 = sp.a_index AS INT), 99)) END AS g1,
         CASE WHEN c0.a1 IS NULL OR c0.a2 IS NULL THEN NULL
              ELSE greatest(CAST(c0.a1 = sp.a_index AS INT), CAST(c0.a2 = sp.a_index AS INT)) END AS g2,
         c0.ad_total - CASE sp.a_index WHEN 1 THEN c0.ad1 WHEN 2 THEN c0.ad2 ELSE c0.ad3 END AS ad_ref,
         CASE WHEN c0.ad0 IS NULL THEN NULL ELSE CASE sp.a_index WHEN 1 THEN c0.ad1 WHEN 2 THEN c0.ad2 ELSE c0.ad3 END END AS ad_alt,
         c0.nalt, c0.pl_seed
  FROM split sp JOIN c0 ON sp.vid = c0.vid),
allele_nums AS (SELECT unnest(range(0, m + 1)) AS k FROM (SELECT max(nalt) AS m FROM fx_calls)),
gts AS (SELECT a.k, b.k AS j, (a.k * (a.k + 1)) // 2 + b.k AS gidx FROM allele_nums a, allele_nums b WHERE b.k <= a.k),
pl AS (
  SELECT cs.vid, cs.a_index, cs.s, any_value(cs.g1) AS g1, any_value(cs.g2) AS g2, any_value(cs.ad_ref) AS ad_ref,
         any_value(cs.ad_alt) AS ad_alt,
         min(CASE WHEN (CAST(g.j = cs.a_index AS INT) + CAST(g.k = cs.a_index AS INT)) = 0 THEN (cs.pl_seed + 31 * g.gidx) % 100 END) AS pl0,
         min(CASE WHEN (CAST(g.j = cs.a_index AS INT) + CAST(g.k = cs.a_index AS INT)) = 1 THEN (cs.pl_seed + 31 * g.gidx) % 100 END) AS pl1,
         min(CASE WHEN (CAST(g.j = cs.a_index AS INT) + CAST(g.k = cs.a_index AS INT)) = 2 THEN (cs.pl_seed + 31 * g.gidx) % 100 END) AS pl2
  FROM cs JOIN gts g ON g.k <= cs.nalt
  GROUP BY cs.vid, cs.a_index, cs.s)
"""


@query("split_calls", _with("fx_sites", "fx_calls") + _SPLIT_SQL + "," + _CALLS_SQL + """
SELECT vid, a_index, s, CAST(g1 AS INT) AS gt_a1, CAST(g2 AS INT) AS gt_a2, CAST(ad_ref AS INT) AS ad_ref, CAST(ad_alt AS INT) AS ad_alt,
       CAST(pl0 AS INT) AS pl0, CAST(pl1 AS INT) AS pl1, CAST(pl2 AS INT) AS pl2
FROM pl""")
def q_split_calls(spark, sf):
    c = SP.split_calls(IN.calls(spark, sf))
    return c.select("vid", "a_index", "s",
                    F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"),
                    F.col("AD")[0].alias("ad_ref"), F.col("AD")[1].alias("ad_alt"),
                    F.col("PL")[0].alias("pl0"), F.col("PL")[1].alias("pl1"), F.col("PL")[2].alias("pl2"))


# calls of one to four alleles, their likelihoods in the order of the genotypes:
# the oracle writes all genotypes out
_PLOIDY_SQL = """
poly AS (
  SELECT vid, s, nalt, pl_seed, a1, CAST(1 + (vid + CAST(substr(s, 2) AS BIGINT)) % 4 AS INT) AS p FROM fx_calls),
g1 AS (SELECT unnest(range(0, 4)) AS x),
gts AS (
  SELECT p, al, row_number() OVER (PARTITION BY p ORDER BY list_reverse(al)) - 1 AS idx FROM (
    SELECT 1 AS p, [a.x] AS al FROM g1 a
    UNION ALL SELECT 2, [a.x, b.x] FROM g1 a, g1 b WHERE a.x <= b.x
    UNION ALL SELECT 3, [a.x, b.x, c.x] FROM g1 a, g1 b, g1 c WHERE a.x <= b.x AND b.x <= c.x
    UNION ALL SELECT 4, [a.x, b.x, c.x, d.x] FROM g1 a, g1 b, g1 c, g1 d WHERE a.x <= b.x AND b.x <= c.x AND c.x <= d.x)),
rows AS (SELECT q.*, sp.a_index, list_transform(range(0, p), lambda i: (a1 + i * (pl_seed + 1)) % (nalt + 1)) AS al
         FROM split sp JOIN poly q ON q.vid = sp.vid),
classes AS (
  SELECT r.vid, r.a_index, r.s, len(list_filter(g.al, lambda x: x = r.a_index)) AS k, min((r.pl_seed + 31 * g.idx) % 100) AS v
  FROM rows r JOIN gts g ON g.p = r.p AND list_max(g.al) <= r.nalt GROUP BY r.vid, r.a_index, r.s, k),
pls AS (SELECT vid, a_index, s, string_agg(CAST(v AS VARCHAR), ',' ORDER BY k) AS pl FROM classes GROUP BY vid, a_index, s)
"""


@query("split_calls_ploidy", _with("fx_sites", "fx_calls") + _SPLIT_SQL + "," + _PLOIDY_SQL + """
SELECT r.vid, r.a_index, r.s, CASE WHEN r.a1 IS NOT NULL THEN array_to_string(list_sort(list_transform(r.al,
         lambda x: CAST(x = r.a_index AS INT))), '/') END AS gt, pls.pl
FROM rows r JOIN pls ON pls.vid = r.vid AND pls.a_index = r.a_index AND pls.s = r.s""")
def q_split_calls_ploidy(spark, sf):
    c = IN.calls(spark, sf)
    n, seed = F.size("alleles"), F.col("PL")[0]
    ploidy = (1 + (F.col("vid") + F.substring("s", 2, 9).cast("long")) % 4).cast("int")
    c = c.withColumns({"_p": ploidy, "_al": F.transform(F.sequence(F.lit(0), ploidy - 1), lambda i: ((F.col("GT.a1") + i * (seed + 1)) % n).cast("int"))})
    more = F.when(F.col("_p") > 2, F.slice("_al", 3, F.greatest(F.col("_p") - 2, F.lit(0))))
    c = c.withColumns({"GT": G.call(F.get("_al", 0), F.get("_al", 1), more=more),
                       "PL": F.transform(F.sequence(F.lit(0), G.n_genotypes(n, F.col("_p")).cast("int") - 1), lambda j: ((seed + j * 31) % 100).cast("int"))})
    out = SP.split_calls(c.drop("_p", "_al", "AD"))
    return out.select("vid", "a_index", "s", F.when(G.is_called(F.col("GT")), KV.gt_text(F.col("GT"), G.more_of(out))).alias("gt"),
                      F.array_join("PL", ",").alias("pl"))


# ------------------------------------------------------------------ R2 / P7
@query("cohort_ac_af", _with("fx_sites") + _SPLIT_SQL + """
SELECT vid, a_index, CAST((vid + 13 * a_index) % 200 AS INT) AS cohort_AC,
       CAST((vid + 13 * a_index) % 200 AS DOUBLE) / 400.0 AS cohort_AF
FROM split""")
def q_cohort_ac_af(spark, sf):
    s = CO.add_cohort_ac_af(SP.split_multi(IN.sites(spark, sf)))
    return s.select("vid", "a_index", F.col("info.cohort_AC").alias("cohort_AC"),
                    F.col("info.cohort_AF").alias("cohort_AF"))


# ================================================================== lookups
from lociframe.operators import lookup as LK  # noqa: E402
from lociframe.operators import intervals as IV  # noqa: E402
from lociframe.operators import packed as PK  # noqa: E402
from lociframe.plans.fixtures import fixture  # noqa: E402


def _split_sites(spark, sf, with_csq=False):
    return SP.split_multi(IN.sites(spark, sf, with_csq=with_csq))


def _score_table(spark, sf, name):
    return LK.variant_key_of(fixture(spark, sf, name))


def _first_by(table: str, keys: str, order: str) -> str:
    return (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM {table}) WHERE rn = 1)")


@query("lookup_mpc", _with("fx_sites", "fx_mpc") + _SPLIT_SQL + f"""
SELECT s.vid, s.a_index, m.mpc AS MPC
FROM split s LEFT JOIN {_first_by('fx_mpc', 'contig, position, ref, alt', 'mpc')} m
  ON s.contig = m.contig AND s.position = m.position AND s.ref = m.ref AND s.alt = m.alt""")
def q_lookup_mpc(spark, sf):
    out = LK.lookup_by_variant(_split_sites(spark, sf), _score_table(spark, sf, "fx_mpc"), {"MPC": "mpc"})
    return out.select("vid", "a_index", F.col("info.MPC").alias("MPC"))


@query("lookup_clinvar", _with("fx_sites", "fx_clinvar") + _SPLIT_SQL + f"""
SELECT s.vid, s.a_index, m.clnsig AS CLNSIG, m.clnrevstat AS CLNREVSTAT
FROM split s LEFT JOIN {_first_by('fx_clinvar', 'contig, position, ref, alt', 'clnsig, clnrevstat')} m
  ON s.contig = m.contig AND s.position = m.position AND s.ref = m.ref AND s.alt = m.alt""")
def q_lookup_clinvar(spark, sf):
    cv = _score_table(spark, sf, "fx_clinvar").withColumnRenamed("clnsig", "CLNSIG") \
        .withColumnRenamed("clnrevstat", "CLNREVSTAT")
    out = LK.clinvar_lookup(_split_sites(spark, sf), cv, "GRCh38")
    return out.select("vid", "a_index", F.col("info.CLNSIG").alias("CLNSIG"),
                      F.col("info.CLNREVSTAT").alias("CLNREVSTAT"))


@query("lookup_revel", _with("fx_sites", "fx_revel") + _SPLIT_SQL + """,
rv AS (SELECT concat('chr', chr) AS contig, TRY_CAST(grch38_pos AS BIGINT) AS position, ref, alt, revel FROM fx_revel),
rk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contig, position, ref, alt ORDER BY revel) AS rn
                      FROM rv WHERE position IS NOT NULL) WHERE rn = 1)
SELECT s.vid, s.a_index, rk.revel AS REVEL
FROM split s LEFT JOIN rk ON s.contig = rk.contig AND s.position = rk.position AND s.ref = rk.ref AND s.alt = rk.alt""")
def q_lookup_revel(spark, sf):
    rv = fixture(spark, sf, "fx_revel").withColumnRenamed("chr", "#chr").withColumnRenamed("revel", "REVEL")
    out = LK.lookup_by_variant(_split_sites(spark, sf), LK.revel_keys(rv, "GRCh38"), {"REVEL": "REVEL"})
    return out.select("vid", "a_index", F.col("info.REVEL").alias("REVEL"))


# ================================================================== intervals
_IV_HITS = """
hits AS (
  SELECT s.vid, s.a_index, i.target, row_number() OVER (PARTITION BY s.vid, s.a_index ORDER BY i.start0, i.end0, i.target) AS rn
  FROM split s JOIN fx_intervals i ON s.contig = i.contig AND s.position > i.start0 AND s.position <= i.end0)
"""


def _intervals(spark, sf):
    return IV.valid_intervals(fixture(spark, sf, "fx_intervals"), "GRCh38")


@query("interval_label", _with("fx_sites", "fx_intervals") + _SPLIT_SQL + "," + _IV_HITS + """
SELECT s.vid, s.a_index, h.target AS PREDICTED_NONCODING
FROM split s LEFT JOIN hits h ON s.vid = h.vid AND s.a_index = h.a_index AND h.rn = 1""")
def q_interval_label(spark, sf):
    out = IV.interval_label(_split_sites(spark, sf), _intervals(spark, sf))
    return out.select("vid", "a_index", F.col("info.PREDICTED_NONCODING").alias("PREDICTED_NONCODING"))


@query("interval_keep_labelled", _with("fx_sites", "fx_intervals") + _SPLIT_SQL + "," + _IV_HITS + """
SELECT h.vid, h.a_index, h.target AS PREDICTED_NONCODING FROM hits h WHERE h.rn = 1""")
def q_interval_keep_labelled(spark, sf):
    out = IV.interval_label(_split_sites(spark, sf), _intervals(spark, sf), keep_only_labelled=True)
    return out.select("vid", "a_index", F.col("info.PREDICTED_NONCODING").alias("PREDICTED_NONCODING"))


# intervals of which one contig's lie inside each other, those of the others
# overlap in chains
_NESTED = """
SELECT 'chr1' AS contig, CAST(1000 + 7 * p_partkey AS BIGINT) AS start0, CAST(1001000 - 9 * p_partkey AS BIGINT) AS end0,
       concat('n', CAST(p_partkey AS VARCHAR(9))) AS target FROM part WHERE p_partkey % 2 = 0
UNION ALL
SELECT concat('chr', CAST(2 + p_partkey % 21 AS VARCHAR(9))) AS contig, CAST((p_partkey * 499) % 1000003 AS BIGINT) AS start0,
       CAST((p_partkey * 499) % 1000003 + 20000 + p_partkey AS BIGINT) AS end0, concat('c', CAST(p_partkey AS VARCHAR(9))) AS target
FROM part WHERE p_partkey % 2 = 1"""


@query("interval_nested", _with("fx_sites") + _SPLIT_SQL + ", nested AS (" + _NESTED + """),
hits AS (
  SELECT s.vid, s.a_index, min({'s': i.start0, 'e': i.end0, 't': i.target}) AS best
  FROM split s JOIN nested i ON s.contig = i.contig AND s.position > i.start0 AND s.position <= i.end0 GROUP BY s.vid, s.a_index)
SELECT s.vid, s.a_index, h.best.t AS label FROM split s LEFT JOIN hits h ON s.vid = h.vid AND s.a_index = h.a_index""")
def q_interval_nested(spark, sf):
    spark.read.parquet(f"{sf}/part.parquet").createOrReplaceTempView("part")
    out = IV.interval_label(_split_sites(spark, sf), spark.sql(_NESTED), out="label", into_info=False)
    return out.select("vid", "a_index", "label")


@query("interval_filter", _with("fx_sites", "fx_intervals") + _SPLIT_SQL + """
SELECT s.vid, s.a_index, s.position FROM split s
WHERE EXISTS (SELECT 1 FROM fx_intervals i WHERE i.contig = s.contig AND s.position > i.start0 AND s.position <= i.end0)""")
def q_interval_filter(spark, sf):
    return IV.interval_filter(_split_sites(spark, sf), _intervals(spark, sf)).select("vid", "a_index", "position")


@query("region_overlap_filter", _with("fx_sites", "fx_intervals") + """
SELECT s.vid, s.position, s.ref FROM fx_sites s
WHERE EXISTS (SELECT 1 FROM fx_intervals i WHERE i.contig = s.contig
              AND s.position <= i.end0 AND s.position + length(s.ref) - 1 >= i.start0 + 1)""")
def q_region_overlap_filter(spark, sf):
    out = IV.region_overlap_filter(IN.sites(spark, sf), _intervals(spark, sf))
    return out.select("vid", "position", F.col("alleles")[0].alias("ref"))


# ================================================================== packed
def _exploded(spark, sf, split=False):
    s = IN.sites(spark, sf, with_csq=True)
    if split:
        s = SP.split_multi(s)
    s = s.withColumn("_tc", PK.parse_entries(F.col("info.CSQ"), IN.CSQ_FIELDS))
    return PK.explode_entries(s)


@query("parse_csq", _with("fx_csq") + """
SELECT vid, ord, symbol AS SYMBOL, feature AS Feature, consequence AS Consequence,
       CAST(len(string_split(consequence, '&')) AS INT) AS n_consequence, hgvsc AS HGVSc, hgvsp AS HGVSp
FROM fx_csq""")
def q_parse_csq(spark, sf):
    e = _exploded(spark, sf)
    return e.select("vid", F.col("csq_pos").alias("ord"), F.col("tc.SYMBOL").alias("SYMBOL"),
                    F.col("tc.Feature").alias("Feature"),
                    F.array_join("tc.Consequence", "&").alias("Consequence"),
                    F.size("tc.Consequence").alias("n_consequence"),
                    F.col("tc.HGVSc").alias("HGVSc"), F.col("tc.HGVSp").alias("HGVSp"))


def _flat(spark, sf, split=False):
    s = IN.sites(spark, sf, with_csq=True)
    key = ["vid", "contig", "position", "alleles"]
    if split:
        s = SP.split_multi(s)
        key.append("a_index")
    return PK.explode_packed(s, F.col("info.CSQ"), IN.CSQ_FIELDS, key)


def _genes_v4(spark, sf):
    return (fixture(spark, sf, "fx_genes_v4").withColumnRenamed("lof_upper", "lof.oe_ci.upper")
            .withColumnRenamed("lof_decile", "lof.oe_ci.upper_bin_decile"))


@query("loeuf_by_transcript", _with("fx_csq", "fx_genes", "fx_genes_v4") + f"""
SELECT c.vid, c.ord,
       CASE WHEN g2.transcript IS NULL THEN '' ELSE g2.oe_lof_upper END AS LOEUF_v2,
       CASE WHEN g2.transcript IS NULL THEN '' ELSE g2.oe_lof_upper_bin END AS LOEUF_v2_decile,
       CASE WHEN g4.transcript IS NULL THEN '' ELSE g4.lof_upper END AS LOEUF_v4,
       CASE WHEN g4.transcript IS NULL THEN '' ELSE g4.lof_decile END AS LOEUF_v4_decile
FROM fx_csq c
LEFT JOIN {_first_by('fx_genes', 'transcript', 'oe_lof_upper, oe_lof_upper_bin')} g2 ON c.feature = g2.transcript
LEFT JOIN {_first_by('fx_genes_v4', 'transcript', 'lof_upper, lof_decile')} g4 ON c.feature = g4.transcript""")
def q_loeuf(spark, sf):
    e = PK.loeuf(_flat(spark, sf), fixture(spark, sf, "fx_genes"), _genes_v4(spark, sf))
    return e.select("vid", F.col("csq_pos").alias("ord"),
                    *[F.col(f"t_{c}").alias(c) for c in ("LOEUF_v2", "LOEUF_v2_decile", "LOEUF_v4", "LOEUF_v4_decile")])


@query("omim_by_gene", _with("fx_csq", "fx_omim") + """
SELECT c.vid, c.ord, coalesce(o.mimNumber, '') AS OMIM_MIM_number, coalesce(o.inheritance_code, '') AS OMIM_inheritance_code
FROM fx_csq c LEFT JOIN fx_omim o ON c.symbol = o.approvedGeneSymbol""")
def q_omim(spark, sf):
    e = PK.omim(_flat(spark, sf), fixture(spark, sf, "fx_omim"))
    return e.select("vid", F.col("csq_pos").alias("ord"), F.col("t_OMIM_MIM_number").alias("OMIM_MIM_number"),
                    F.col("t_OMIM_inheritance_code").alias("OMIM_inheritance_code"))


@query("gene_list_flag", _with("fx_csq", "fx_gene_list", "fx_gene_list_b") + """
SELECT c.vid, c.ord,
       concat_ws('&', CASE WHEN c.symbol IN (SELECT symbol FROM fx_gene_list) THEN 'genes_a.txt' END,
                      CASE WHEN c.symbol IN (SELECT symbol FROM fx_gene_list_b) THEN 'genes_b.txt' END) AS gene_list
FROM fx_csq c""")
def q_gene_list(spark, sf):
    e = PK.gene_lists(_flat(spark, sf), [("genes_a.txt", fixture(spark, sf, "fx_gene_list")),
                                         ("genes_b.txt", fixture(spark, sf, "fx_gene_list_b"))])
    return e.select("vid", F.col("csq_pos").alias("ord"), F.col("t_gene_list").alias("gene_list"))


_SPLICE_COLS = ", ".join(
    f"CASE WHEN sa.spliceai IS NULL THEN '' ELSE string_split(string_split(sa.spliceai, '=')[2], '|')[{i + 3}] END AS {f}"
    for i, f in enumerate(PK.SPLICEAI_FIELDS))


@query("spliceai_by_gene", _with("fx_sites", "fx_csq", "fx_spliceai") + _SPLIT_SQL + f"""
SELECT s.vid, s.a_index, c.ord, {_SPLICE_COLS}
FROM split s JOIN fx_csq c ON s.vid = c.vid
LEFT JOIN fx_spliceai sa ON s.contig = sa.contig AND s.position = sa.position AND s.ref = sa.ref AND s.alt = sa.alt
                         AND c.symbol = sa.symbol""")
def q_spliceai(spark, sf):
    t = (LK.variant_key_of(fixture(spark, sf, "fx_spliceai"))
         .withColumnRenamed("symbol", "SYMBOL").withColumnRenamed("spliceai", "SpliceAI"))
    e = PK.spliceai(_flat(spark, sf, split=True), t)
    return e.select("vid", "a_index", F.col("csq_pos").alias("ord"), *[F.col(f"t_{f}").alias(f) for f in PK.SPLICEAI_FIELDS])


@query("hgvsc_symbol", _with("fx_csq") + """
SELECT vid, ord, concat_ws(', ', symbol, CASE WHEN hgvsc <> '' THEN split_part(hgvsc, ':', 2) END,
                                 CASE WHEN hgvsp <> '' THEN split_part(hgvsp, ':', 2) END) AS HGVSc_symbol
FROM fx_csq""")
def q_hgvsc_symbol(spark, sf):
    e = _flat(spark, sf)
    return e.select("vid", F.col("csq_pos").alias("ord"),
                    PK.hgvsc_symbol(F.col("t_SYMBOL"), F.col("t_HGVSc"), F.col("t_HGVSp")).alias("HGVSc_symbol"))


_ENTRY_SQL = "concat(symbol, '|', feature, '|', consequence, '|', hgvsc, '|', hgvsp)"


@query("pack_csq", _with("fx_sites", "fx_csq") + f"""
SELECT s.vid, p.csq AS CSQ FROM fx_sites s
LEFT JOIN (SELECT vid, string_agg({_ENTRY_SQL}, ',' ORDER BY ord) AS csq FROM fx_csq GROUP BY vid) p ON s.vid = p.vid""")
def q_pack_csq(spark, sf):
    s = IN.sites(spark, sf, with_csq=True)
    e = PK.explode_packed(s, F.col("info.CSQ"), IN.CSQ_FIELDS)
    packed = PK.regroup(e, IN.CSQ_FIELDS)
    return s.join(packed, ["contig", "position", "alleles"], "left").select("vid", "CSQ")


@query("pack_csq_array", _with("fx_csq") + f"""
SELECT vid, ord, concat({_ENTRY_SQL}, '|', concat_ws(', ', symbol, CASE WHEN hgvsc <> '' THEN split_part(hgvsc, ':', 2) END,
                                 CASE WHEN hgvsp <> '' THEN split_part(hgvsp, ':', 2) END)) AS entry
FROM fx_csq""")
def q_pack_csq_array(spark, sf):
    e = _flat(spark, sf)
    e = e.withColumn("t_HGVSc_symbol", PK.hgvsc_symbol(F.col("t_SYMBOL"), F.col("t_HGVSc"), F.col("t_HGVSp")))
    packed = PK.regroup(e, IN.CSQ_FIELDS + ["HGVSc_symbol"], key=["vid"], as_array=True)
    return packed.select("vid", F.posexplode("CSQ").alias("ord", "entry"))


# ================================================================== genotypes
from lociframe.operators import genotypes as GT  # noqa: E402
from lociframe.operators import filters as FL  # noqa: E402

_AD_SUM = "CASE WHEN ad0 IS NULL THEN NULL ELSE ad0 + coalesce(ad1, 0) + coalesce(ad2, 0) + coalesce(ad3, 0) END"
_A2_DIPLOID = "CASE WHEN a1 IS NULL THEN NULL ELSE coalesce(a2, a1) END"


@query("haploid_to_diploid", _with("fx_calls") + f"""
SELECT vid, s, a1 AS gt_a1, {_A2_DIPLOID} AS gt_a2 FROM fx_calls""")
def q_haploid_to_diploid(spark, sf):
    c = GT.haploid_to_diploid(IN.calls(spark, sf))
    return c.select("vid", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"))


@query("format_dp", _with("fx_calls") + f"""
SELECT vid, s, CAST({_AD_SUM} AS INT) AS DP FROM fx_calls""")
def q_format_dp(spark, sf):
    return GT.format_depth(IN.calls(spark, sf)).select("vid", "s", "DP")


@query("info_dp", _with("fx_sites_t", "fx_calls_t") + f"""
SELECT s.vid, CAST(coalesce(d.dp, 0) AS INT) AS DP
FROM fx_sites_t s LEFT JOIN (SELECT vid, sum({_AD_SUM}) AS dp FROM fx_calls_t GROUP BY vid) d ON s.vid = d.vid""")
def q_info_dp(spark, sf):
    s = IN.sites(spark, sf, twins=True)
    out = CO.info_depth(s, IN.calls(spark, sf, twins=True))
    return out.select("vid", F.col("info.DP").alias("DP"))


@query("estimated_pl", _with("fx_calls") + f"""
d AS (SELECT vid, s, a1, {_A2_DIPLOID} AS a2, gq, ad0, ad1 FROM fx_calls),
m AS (SELECT *, CASE WHEN ad0 IS NULL THEN gq ELSE greatest(gq, 3 * (ad0 - ad1)) END AS mx FROM d)
SELECT vid, s,
       CAST(CASE WHEN a1 IS NULL THEN NULL WHEN a1 = 0 AND a2 = 0 THEN 0 WHEN a1 = a2 THEN mx ELSE gq END AS INT) AS pl0,
       CAST(CASE WHEN a1 IS NULL THEN NULL WHEN a1 = 0 AND a2 = 0 THEN gq WHEN a1 = a2 THEN gq ELSE 0 END AS INT) AS pl1,
       CAST(CASE WHEN a1 IS NULL THEN NULL WHEN a1 = 0 AND a2 = 0 THEN mx WHEN a1 = a2 THEN 0 ELSE mx END AS INT) AS pl2
FROM m""".replace("\n,", ","))
def q_estimated_pl(spark, sf):
    c = GT.estimate_pl(GT.haploid_to_diploid(IN.calls(spark, sf)))
    return c.select("vid", "s", F.get("PL", 0).alias("pl0"), F.get("PL", 1).alias("pl1"), F.get("PL", 2).alias("pl2"))


@query("recompute_ac_af", _with("fx_sites_t", "fx_calls_t") + _twins(_SPLIT_SQL + "," + _CALLS_SQL) + """
, st AS (SELECT vid, a_index, sum(CASE WHEN g1 IS NULL THEN 0 WHEN g2 IS NULL THEN 1 ELSE 2 END) AS an,
                sum(coalesce(g1, 0) + coalesce(g2, 0)) AS ac FROM cs GROUP BY vid, a_index)
SELECT s.vid, s.a_index, CAST(coalesce(st.ac, 0) AS INT) AS cohort_AC,
       CASE WHEN coalesce(st.an, 0) = 0 THEN NULL ELSE CAST(st.ac AS DOUBLE) / st.an END AS cohort_AF
FROM split s LEFT JOIN st ON s.vid = st.vid AND s.a_index = st.a_index""".replace("\n,", ","))
def q_recompute_ac_af(spark, sf):
    s = SP.split_multi(IN.sites(spark, sf, twins=True))
    c = SP.split_calls(IN.calls(spark, sf, twins=True))
    out = CO.recompute_cohort_ac_af(s, c)
    return out.select("vid", "a_index", F.col("info.cohort_AC").alias("cohort_AC"),
                      F.col("info.cohort_AF").alias("cohort_AF"))


@query("variant_qc", _with("fx_sites_t", "fx_calls_t") + _twins("""
al AS (SELECT vid, a1 AS a FROM fx_calls WHERE a1 IS NOT NULL
         UNION ALL SELECT vid, a2 AS a FROM fx_calls WHERE a1 IS NOT NULL AND a2 IS NOT NULL),
an AS (SELECT vid, count(*) AS an FROM al GROUP BY vid),
idx AS (SELECT vid, unnest(range(0, len(string_split(alts, ',')) + 1)) AS allele FROM fx_sites WHERE vid IN (SELECT vid FROM an))
SELECT idx.vid, CAST(idx.allele AS INT) AS allele, CAST(coalesce(c.n, 0) AS INT) AS AC, CAST(an.an AS INT) AS AN,
       coalesce(c.n, 0) / an.an AS AF
FROM idx JOIN an ON idx.vid = an.vid
LEFT JOIN (SELECT vid, a, count(*) AS n FROM al GROUP BY vid, a) c ON idx.vid = c.vid AND idx.allele = c.a""").replace("\n,", ","))
def q_variant_qc(spark, sf):
    qc = CO.variant_qc(IN.calls(spark, sf, twins=True))
    return qc.select(F.col("record").alias("vid"), F.posexplode(F.arrays_zip("AC", "AF")).alias("allele", "z"), "AN") \
             .select("vid", "allele", F.col("z.AC").alias("AC"), "AN", F.col("z.AF").alias("AF"))


@query("missing_counts", _with("fx_sites") + _SPLIT_SQL + """
SELECT CAST(0 AS BIGINT) AS n_missing_AS_VQSLOD, CAST(count(*) FILTER (WHERE s.vqslod IS NULL) AS BIGINT) AS n_missing_VQSLOD
FROM split sp JOIN fx_sites s ON sp.vid = s.vid""")
def q_missing_counts(spark, sf):
    return CO.missing_counts(SP.split_multi(IN.sites(spark, sf)), ["AS_VQSLOD", "VQSLOD"])


@query("as_backfill", _with("fx_sites") + _SPLIT_SQL + """
, j AS (SELECT sp.vid, sp.a_index, s.vqslod FROM split sp JOIN fx_sites s ON sp.vid = s.vid),
dec AS (SELECT count(*) FILTER (WHERE vqslod IS NULL) > 0 AS fire FROM j)
SELECT j.vid, j.a_index, CAST(CASE WHEN dec.fire THEN (j.vid * j.a_index) % 100 ELSE j.vqslod END AS INT) AS VQSLOD
FROM j, dec""".replace("\n,", ","))
def q_as_backfill(spark, sf):
    out = CO.backfill_allele_specific(SP.split_multi(IN.sites(spark, sf)))
    return out.select("vid", "a_index", F.col("info.VQSLOD").alias("VQSLOD"))


@query("sample_subset_ac", _with("fx_calls", "fx_keep_samples") + f"""
k AS (SELECT vid, s, a1, {_A2_DIPLOID} AS a2 FROM fx_calls WHERE s IN (SELECT s FROM fx_keep_samples)),
v AS (SELECT vid FROM k GROUP BY vid HAVING sum(CASE WHEN a1 = 1 THEN 1 ELSE 0 END + CASE WHEN a2 = 1 THEN 1 ELSE 0 END) > 0)
SELECT vid, s, a1 AS gt_a1, a2 AS gt_a2 FROM k WHERE vid IN (SELECT vid FROM v)""".replace("\n,", ","))
def q_sample_subset_ac(spark, sf):
    s = IN.sites(spark, sf)
    _, c = FL.subset_samples(s, IN.calls(spark, sf, s), fixture(spark, sf, "fx_keep_samples"))
    return c.select("vid", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"))


@query("drop_first_sample", _with("fx_calls", "fx_samples") + """
SELECT c.vid, c.s FROM fx_calls c JOIN fx_samples m ON c.s = m.s WHERE m.ordinal > 0""")
def q_drop_first_sample(spark, sf):
    c = FL.drop_first_sample(IN.calls(spark, sf), fixture(spark, sf, "fx_samples"))
    return c.select("vid", "s")


@query("adj_filter", _with("fx_calls") + f"""
d AS (SELECT *, {_AD_SUM} AS dp,
              CASE a1 WHEN 0 THEN ad0 WHEN 1 THEN ad1 WHEN 2 THEN ad2 ELSE ad3 END AS ad_a1,
              CASE a2 WHEN 0 THEN ad0 WHEN 1 THEN ad1 WHEN 2 THEN ad2 ELSE ad3 END AS ad_a2 FROM fx_calls)
SELECT vid, s, a1 AS gt_a1, a2 AS gt_a2 FROM d
WHERE a1 IS NOT NULL AND gq >= 20
  AND CASE WHEN a2 IS NULL THEN dp >= 5 ELSE dp >= 10 END
  AND CASE WHEN a2 IS NULL OR a1 = a2 THEN TRUE
           WHEN a1 = 0 THEN ad_a2 / dp >= 0.2
           WHEN a2 = 0 THEN ad_a1 / dp >= 0.2
           ELSE ad_a1 / dp >= 0.2 AND ad_a2 / dp >= 0.2 END""".replace("\n,", ","))
def q_adj_filter(spark, sf):
    c = GT.filter_to_adj(GT.format_depth(IN.calls(spark, sf)))
    return c.select("vid", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"))


@query("add_genotypes", _with("fx_sites_t", "fx_calls_t", "fx_mpc") + _twins(_SPLIT_SQL + "," + _CALLS_SQL) + f"""
SELECT cs.vid, cs.a_index, cs.s, CAST(cs.g1 AS INT) AS gt_a1,
       CAST(CASE WHEN cs.g1 IS NULL THEN NULL ELSE coalesce(cs.g2, cs.g1) END AS INT) AS gt_a2, m.mpc AS MPC
FROM cs JOIN split s ON cs.vid = s.vid AND cs.a_index = s.a_index
LEFT JOIN {_first_by('fx_mpc', 'contig, position, ref, alt', 'mpc')} m
  ON s.contig = m.contig AND s.position = m.position AND s.ref = m.ref AND s.alt = m.alt""")
def q_add_genotypes(spark, sf):
    from lociframe.operators.merge import add_genotypes
    s = IN.sites(spark, sf, twins=True)
    annotated = LK.lookup_by_variant(SP.split_multi(s), _score_table(spark, sf, "fx_mpc"), {"MPC": "mpc"})
    out = add_genotypes(annotated.drop("vid"), IN.calls(spark, sf, twins=True))
    return out.select("vid", "a_index", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"),
                      F.col("info.MPC").alias("MPC"))


# ================================================================== counts, order, shards
from lociframe.operators import counts as CT  # noqa: E402
from lociframe.operators import sharding as SH  # noqa: E402

_CONTIG_ORD = ("CASE substr(contig, 4) WHEN 'X' THEN 23 WHEN 'Y' THEN 24 "
               "ELSE TRY_CAST(substr(contig, 4) AS INT) END")
_RANKED = f"""
ranked AS (SELECT vid, contig, position, ref, alts,
                  row_number() OVER (ORDER BY {_CONTIG_ORD}, position, ref, alts) AS rn,
                  count(*) OVER () AS total
           FROM fx_sites)
"""


@query("variant_counts", _with("fx_sites") + """
per_shard AS (SELECT contig, count(*) AS n_records,
                     count(*) FILTER (WHERE length(ref) = 1 AND length(alts) = 1) AS n_snv,
                     count(*) FILTER (WHERE length(ref) <> length(alts)) AS n_indel
              FROM fx_sites GROUP BY contig)
SELECT CAST(sum(n_records) AS BIGINT) AS n_records, CAST(sum(n_snv) AS BIGINT) AS n_snv,
       CAST(sum(n_indel) AS BIGINT) AS n_indel FROM per_shard""")
def q_variant_counts(spark, sf):
    return CT.total_of_shards(CT.variant_type_counts(IN.sites(spark, sf), by="contig"))


@query("records_per_contig", cte("fx_sites") + """
SELECT contig, count(*) AS n_records FROM fx_sites GROUP BY contig""")
def q_records_per_contig(spark, sf):
    return CT.records_per_contig(IN.sites(spark, sf))


@query("coordinate_sort", _with("fx_sites") + _RANKED + """
SELECT vid, rn FROM ranked""")
def q_coordinate_sort(spark, sf):
    return SH.coordinate_sort(IN.sites(spark, sf)).select("vid", "rn")


@query("shard_fixed", _with("fx_sites") + _RANKED + """
SELECT vid, CAST(((rn - 1) * 7) // total AS BIGINT) AS shard FROM ranked""")
def q_shard_fixed(spark, sf):
    return SH.shard_fixed(IN.sites(spark, sf), 7).select("vid", "shard")


@query("shard_by_records", _with("fx_sites") + _RANKED + """
SELECT vid, CAST((rn - 1) // 1000 AS BIGINT) AS shard FROM ranked""")
def q_shard_by_records(spark, sf):
    return SH.shard_by_records(IN.sites(spark, sf), 1000).select("vid", "shard")


@query("shard_by_contig", _with("fx_sites") + _RANKED + """
SELECT vid, concat(contig, '_', CAST((rn - min(rn) OVER (PARTITION BY contig)) // 200 AS VARCHAR)) AS shard FROM ranked""")
def q_shard_by_contig(spark, sf):
    return SH.shard_by_contig(IN.sites(spark, sf), "GRCh38", 200).select("vid", "shard")


@query("keep_contig", cte("fx_sites") + """
SELECT vid, position FROM fx_sites WHERE contig = 'chr5'""")
def q_keep_contig(spark, sf):
    return FL.keep_contig(IN.sites(spark, sf), "chr5").select("vid", "position")


@query("chunk_rows", cte("fx_pedigree") + """
SELECT sample_id, CAST((row_number() OVER (ORDER BY sample_id) - 1) // 100 AS BIGINT) AS chunk FROM fx_pedigree""")
def q_chunk_rows(spark, sf):
    return SH.chunk_rows(fixture(spark, sf, "fx_pedigree"), 100, "sample_id").select("sample_id", "chunk")


@query("chunk_families", _with("fx_pedigree") + """
fam AS (SELECT family_id, min(sample_id) AS first_seen FROM fx_pedigree GROUP BY family_id),
fc AS (SELECT family_id, (row_number() OVER (ORDER BY first_seen) - 1) // 7 AS chunk FROM fam)
SELECT p.sample_id, p.family_id, CAST(fc.chunk AS BIGINT) AS chunk FROM fx_pedigree p JOIN fc ON p.family_id = fc.family_id""")
def q_chunk_families(spark, sf):
    out = SH.chunk_families(fixture(spark, sf, "fx_pedigree"), 7, "sample_id")
    return out.select("sample_id", "family_id", "chunk")


@query("sample_chunk_pairs", _with("fx_pedigree") + """
ch AS (SELECT sample_id AS s, (row_number() OVER (ORDER BY sample_id) - 1) // 250 AS chunk FROM fx_pedigree),
ids AS (SELECT DISTINCT chunk FROM ch),
pairs AS (SELECT a.chunk AS i, b.chunk AS j, row_number() OVER (ORDER BY a.chunk, b.chunk) - 1 AS shard
          FROM ids a JOIN ids b ON a.chunk < b.chunk)
SELECT CAST(p.shard AS BIGINT) AS shard, c.s FROM pairs p JOIN ch c ON c.chunk = p.i
UNION ALL
SELECT CAST(p.shard AS BIGINT) AS shard, c.s FROM pairs p JOIN ch c ON c.chunk = p.j""")
def q_sample_chunk_pairs(spark, sf):
    ped = fixture(spark, sf, "fx_pedigree").select(F.col("sample_id").alias("s"))
    return SH.sample_chunk_pairs(ped, 250).select("shard", "s")


# ================================================================== unions / merges
from lociframe.operators import merge as MG  # noqa: E402


def _cohort_b(spark, sf, rename=True):
    """Two cohorts, each with variants of its own: all but ``vid % 5 = 0``, and
    all but ``vid % 5 = 1`` under other sample names."""
    s, c = IN.sites(spark, sf), IN.calls(spark, sf)
    in_a, in_b = F.col("vid") % 5 != 0, F.col("vid") % 5 != 1
    cb = c.where(in_b).withColumn("PGT", F.lit("0|1"))
    if rename:
        cb = cb.withColumn("s", F.concat(F.lit("T"), F.substring("s", 2, 8)))
    return s.where(in_a), c.where(in_a), s.where(in_b), cb


@query("union_cohorts", cte("fx_calls") + """
SELECT vid, s, a1 AS gt_a1, a2 AS gt_a2, gq AS GQ FROM fx_calls WHERE vid % 5 > 1
UNION ALL
SELECT vid, concat('T', substr(s, 2)) AS s, a1 AS gt_a1, a2 AS gt_a2, gq AS GQ FROM fx_calls WHERE vid % 5 > 1""")
def q_union_cohorts(spark, sf):
    sa, ca, sb, cb = _cohort_b(spark, sf)
    _, calls = MG.union_cohorts(sa, ca, sb, cb)
    calls = calls.join(IN.sites(spark, sf).select("contig", "position", "alleles", "vid"), ["contig", "position", "alleles"])
    return calls.select("vid", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"), "GQ")


@query("union_cohorts_twins", _with("fx_sites_t", "fx_calls_t") + _twins(_SPLIT_SQL + "," + _CALLS_SQL + """,
a_sites AS (SELECT *, row_number() OVER (PARTITION BY contig, position, ref, alt ORDER BY vid, a_index) AS nth FROM split WHERE vid % 5 <> 0),
b_sites AS (SELECT *, row_number() OVER (PARTITION BY contig, position, ref, alt ORDER BY vid, a_index) AS nth FROM split WHERE vid % 3 <> 1),
shared AS (SELECT a.contig, a.position, a.ref, a.alt, a.nth, a.vid AS a_vid, a.a_index AS a_i, b.vid AS b_vid, b.a_index AS b_i
           FROM a_sites a JOIN b_sites b ON a.contig = b.contig AND a.position = b.position AND a.ref = b.ref AND a.alt = b.alt AND a.nth = b.nth)
SELECT contig, position, ref, alt, nth AS occurrence, s, CAST(g1 AS INT) AS gt_a1, CAST(g2 AS INT) AS gt_a2
FROM shared JOIN pl ON pl.vid = a_vid AND pl.a_index = a_i
UNION ALL
SELECT contig, position, ref, alt, nth, concat('T', substr(s, 2)), CAST(g1 AS INT), CAST(g2 AS INT)
FROM shared JOIN pl ON pl.vid = b_vid AND pl.a_index = b_i"""))
def q_union_cohorts_twins(spark, sf):
    """Split cohorts in which records share a key, not the same ones in both."""
    s, c = SP.split_multi(IN.sites(spark, sf, twins=True)), SP.split_calls(IN.calls(spark, sf, twins=True))
    in_a, in_b = F.col("vid") % 5 != 0, F.col("vid") % 3 != 1
    cb = c.where(in_b).withColumn("s", F.concat(F.lit("T"), F.substring("s", 2, 8)))
    _, calls = MG.union_cohorts(s.where(in_a), c.where(in_a), s.where(in_b), cb)
    return calls.select("contig", "position", F.col("alleles")[0].alias("ref"), F.col("alleles")[1].alias("alt"),
                        F.col("occurrence").cast("long").alias("occurrence"), "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"))


@query("merge_samples", cte("fx_calls") + """
SELECT vid, s, a1 AS gt_a1, a2 AS gt_a2 FROM fx_calls WHERE vid % 3 <> 0
UNION ALL
SELECT vid, concat('2:', s) AS s, a1 AS gt_a1, a2 AS gt_a2 FROM fx_calls WHERE vid % 3 <> 1""")
def q_merge_samples(spark, sf):
    s = IN.sites(spark, sf)
    c = IN.calls(spark, sf, s)
    smp = fixture(spark, sf, "fx_samples")
    f1 = (s.where(F.col("vid") % 3 != 0), c.where(F.col("vid") % 3 != 0), smp)
    f2 = (s.where(F.col("vid") % 3 != 1), c.where(F.col("vid") % 3 != 1), smp)
    _, calls, _ = MG.merge_sample_sets([f1, f2])
    return calls.select("vid", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"))


@query("merge_samples_sites", cte("fx_sites") + """
SELECT vid, position FROM fx_sites""")
def q_merge_samples_sites(spark, sf):
    s = IN.sites(spark, sf)
    c = IN.calls(spark, sf, s)
    smp = fixture(spark, sf, "fx_samples")
    f1 = (s.where(F.col("vid") % 3 != 0), c.where(F.col("vid") % 3 != 0), smp)
    f2 = (s.where(F.col("vid") % 3 != 1), c.where(F.col("vid") % 3 != 1), smp)
    sites, _, _ = MG.merge_sample_sets([f1, f2])
    return sites.select("vid", "position")


@query("concat_tables_by_name", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT s_suppkey AS key, s_name AS name, CAST(NULL AS INT) AS nation, s_acctbal AS balance FROM supplier""")
def q_concat_by_name(spark, sf):
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    supp = spark.read.parquet(f"{sf}/supplier.parquet")
    t1 = cust.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    t2 = supp.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return MG.union_tables([t1, t2])


@query("concat_tables_by_position", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def q_concat_by_position(spark, sf):
    t1 = spark.read.parquet(f"{sf}/customer.parquet").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    t2 = spark.read.parquet(f"{sf}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    return MG.union_by_position([t1, t2])


@query("concat_records_sorted", _with("fx_sites") + _RANKED + """
SELECT vid, CAST(vid % 2 + 1 AS INT) AS file_idx, rn FROM ranked""")
def q_concat_records_sorted(spark, sf):
    s = IN.sites(spark, sf)
    out = MG.concat_records([s.where(F.col("vid") % 2 == 0), s.where(F.col("vid") % 2 == 1)], allow_overlaps=True)
    return out.select("vid", "file_idx", "rn")


@query("union_record_sets", cte("fx_sites") + """
SELECT vid, CAST(vid % 3 + 1 AS INT) AS file_idx FROM fx_sites""")
def q_union_record_sets(spark, sf):
    s = IN.sites(spark, sf)
    parts = [s.where(F.col("vid") % 3 == i) for i in range(3)]
    return MG.concat_records(parts).select("vid", "file_idx")


@query("keep_format_fields", cte("fx_calls") + """
SELECT vid, s, a1 AS gt_a1, gq AS GQ FROM fx_calls""")
def q_keep_format_fields(spark, sf):
    c = GT.format_depth(IN.calls(spark, sf)).withColumn("PGT", F.lit("0|1")).withColumn("MIN_DP", F.lit(3))
    kept = GT.keep_format_fields(c)
    return kept.select("vid", "s", F.col("GT.a1").alias("gt_a1"), "GQ")


# ================================================================== ancestry
from lociframe.operators import ancestry as AN  # noqa: E402


def _loadings(spark, sf, sites):
    ld = fixture(spark, sf, "fx_loadings")
    return ld.join(sites.select("vid", "contig", "position", "alleles"), "vid").drop("vid")


def _scores_long(scores: DataFrame, *extra) -> DataFrame:
    return scores.select("s", *extra, F.posexplode("scores").alias("pc", "score")) \
                 .select("s", *extra, F.col("pc").cast("int").alias("pc"), F.round("score", 6).alias("score"))


_PROJECT_SQL = """
nv AS (SELECT count(*) AS n FROM fx_loadings),
ld AS (SELECT vid, loadings, pca_af FROM fx_loadings WHERE pca_af > 0 AND pca_af < 1),
u AS (SELECT vid, pca_af, unnest(loadings) AS w, generate_subscripts(loadings, 1) - 1 AS pc FROM ld),
x AS (SELECT g.s, u.pc, u.w * (g.nalt - 2 * u.pca_af) / sqrt(nv.n * 2 * u.pca_af * (1 - u.pca_af)) AS v
      FROM g JOIN u ON g.vid = u.vid CROSS JOIN nv)
"""


@query("pc_project", _with("fx_calls", "fx_loadings") + """
g AS (SELECT vid, s, CASE WHEN a1 > 0 THEN 1 ELSE 0 END + CASE WHEN a2 > 0 THEN 1 ELSE 0 END AS nalt
      FROM fx_calls WHERE a1 IS NOT NULL),""" + _PROJECT_SQL + """
SELECT s, CAST(pc AS INT) AS pc, round(sum(v), 6) AS score FROM x GROUP BY s, pc""")
def q_pc_project(spark, sf):
    s = IN.sites(spark, sf)
    ld = _loadings(spark, sf, s)
    return _scores_long(AN.pc_project(IN.calls(spark, sf), ld))


@query("ancestry_scores", _with("fx_calls", "fx_loadings", "fx_pop_labels") + f"""
d AS (SELECT *, {_AD_SUM} AS dp,
             CASE a1 WHEN 0 THEN ad0 WHEN 1 THEN ad1 WHEN 2 THEN ad2 ELSE ad3 END AS ad_a1,
             CASE a2 WHEN 0 THEN ad0 WHEN 1 THEN ad1 WHEN 2 THEN ad2 ELSE ad3 END AS ad_a2 FROM fx_calls),
cohort AS (SELECT vid, concat('C', substr(s, 2)) AS s, a1, a2 FROM d
           WHERE vid % 10 > 1 AND a1 IS NOT NULL AND gq >= 20
             AND CASE WHEN a2 IS NULL THEN dp >= 5 ELSE dp >= 10 END
             AND CASE WHEN a2 IS NULL OR a1 = a2 THEN TRUE
                      WHEN a1 = 0 THEN ad_a2 / dp >= 0.2
                      WHEN a2 = 0 THEN ad_a1 / dp >= 0.2
                      ELSE ad_a1 / dp >= 0.2 AND ad_a2 / dp >= 0.2 END),
lab AS (SELECT Sample, replace(replace(SuperPop, 'CSA', 'SAS'), 'EUR', 'NFE') AS pop FROM fx_pop_labels),
lab2 AS (SELECT * FROM lab WHERE pop <> 'OCE'),
panel AS (SELECT vid, s, a1, a2 FROM fx_calls WHERE vid % 10 > 1 AND s IN (SELECT Sample FROM lab2)),
g AS (SELECT vid, s, CASE WHEN a1 > 0 THEN 1 ELSE 0 END + CASE WHEN a2 > 0 THEN 1 ELSE 0 END AS nalt
      FROM (SELECT * FROM cohort UNION ALL SELECT * FROM panel) WHERE a1 IS NOT NULL),""" + _PROJECT_SQL + """
SELECT x.s, CAST(x.pc AS INT) AS pc, round(sum(x.v), 6) AS score, lower(lab2.pop) AS known_pop
FROM x LEFT JOIN lab2 ON x.s = lab2.Sample GROUP BY x.s, x.pc, lab2.pop""")
def q_ancestry_scores(spark, sf):
    s = IN.sites(spark, sf)
    ld = _loadings(spark, sf, s)
    labels = FL.clean_population_labels(fixture(spark, sf, "fx_pop_labels"))
    all_calls = IN.calls(spark, sf, s)
    # each side lacks a tenth of the variants that the other has
    in_cohort, in_panel = F.col("vid") % 10 != 0, F.col("vid") % 10 != 1
    panel = FL.keep_samples(all_calls.where(in_panel), labels.select("Sample"))
    cohort = GT.filter_to_adj(GT.format_depth(
        all_calls.where(in_cohort).withColumn("s", F.concat(F.lit("C"), F.substring("s", 2, 8)))))
    _, calls = MG.union_cohorts(s.where(in_cohort), cohort, s.where(in_panel), panel)
    scores = AN.pc_project(calls, ld)
    scores = AN.attach_known_population(scores, labels).where(F.col("scores").isNotNull())
    return _scores_long(scores, "known_pop")


# the forest itself is beyond SQL; what must hold of its output is not
_ASSIGN_SQL = """
SELECT concat('E', CAST(vec_id AS VARCHAR)) AS s, CASE WHEN vec_id % 4 <> 0 THEN concat('pop', CAST(label AS VARCHAR)) END AS known_pop,
       TRUE AS sums_to_one, TRUE AS follows_rule FROM embeddings"""


def _labelled_scores(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    scores = emb.select(F.concat(F.lit("E"), F.col("vec_id").cast("string")).alias("s"),
                        F.col("embedding").cast("array<double>").alias("scores"),
                        F.when(F.col("vec_id") % 4 != 0, F.concat(F.lit("pop"), F.col("label").cast("string")))
                        .alias("known_pop"))
    return scores


def _assignment_holds(out):
    """The probabilities sum to 1, and ``pop`` is the class of the largest one,
    or ``oth`` exactly where that is below the threshold."""
    probs = [c for c in out.columns if c.startswith("prob_")]
    largest = F.greatest(*probs)
    named = F.coalesce(*[F.when(F.col(c) == largest, F.lit(c.removeprefix("prob_"))) for c in probs])
    return out.select("s", "known_pop", (F.abs(sum(F.col(c) for c in probs) - 1) < 1e-6).alias("sums_to_one"),
                      (F.col("pop") == F.when(largest >= 0.75, named).otherwise("oth")).alias("follows_rule"))


@query("assign_ancestry", _ASSIGN_SQL)
def q_assign_ancestry(spark, sf):
    return _assignment_holds(AN.assign_population(_labelled_scores(spark, sf), num_pcs=16, min_prob=0.75))


@query("assign_ancestry_saved", _ASSIGN_SQL)
def q_assign_ancestry_saved(spark, sf):
    """A model saved, loaded and applied: ``follows_rule`` also says that it
    assigns what the fitted one does."""
    scores = _labelled_scores(spark, sf)
    fitted, model = AN.assign_population(scores, num_pcs=16, min_prob=0.75, return_model=True)
    path = IN.stored_path(spark, sf, "population-model", lambda p: model.write().overwrite().save(p))
    applied = AN.apply_population_model(scores, AN.load_population_model(path), min_prob=0.75, num_pcs=16)
    same = fitted.select("s", F.col("pop").alias("fitted_pop"))
    out = _assignment_holds(applied).join(applied.select("s", "pop"), "s").join(same, "s")
    return out.select("s", "known_pop", "sums_to_one", (F.col("follows_rule") & (F.col("pop") == F.col("fitted_pop"))).alias("follows_rule"))


# ================================================================== VCF text in / out
from lociframe.sinks import vcf as KV  # noqa: E402
from lociframe.sources import vcf as SV  # noqa: E402

FIXTURE_HEADER_LINES = [
    "##fileformat=VCFv4.2",
    '##FILTER=<ID=PASS,Description="All filters passed">',
    '##FILTER=<ID=LowQual,Description="Low quality">',
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">',
    '##INFO=<ID=AF,Number=A,Type=Float,Description="Allele frequency">',
    '##INFO=<ID=VQSLOD,Number=1,Type=Integer,Description="Site log-odds">',
    '##INFO=<ID=AS_VQSLOD,Number=A,Type=Integer,Description="Allele-specific log-odds">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="Allelic depths">',
    '##FORMAT=<ID=GQ,Number=1,Type=Integer,Description="Genotype quality">',
    '##FORMAT=<ID=PL,Number=G,Type=Integer,Description="Phred-scaled likelihoods">',
]


def _fixture_vcf(spark, sf, twins=False):
    s = IN.sites(spark, sf, twins=twins).withColumn("rsid", F.concat(F.lit("v"), F.col("vid").cast("string")))
    c = IN.calls(spark, sf, twins=twins).drop("vid")
    smp = fixture(spark, sf, "fx_samples")
    return s.drop("vid"), c, smp


_RENDER_SQL = """
inf AS (SELECT vid, concat_ws(';',
          'AC=' || array_to_string(list_transform(range(1, n + 1), lambda i: (vid + 13 * i) % 200), ','),
          'AF=' || array_to_string(list_transform(range(1, n + 1), lambda i: CAST(((vid + 13 * i) % 200) / 400.0 AS VARCHAR)), ','),
          CASE WHEN vqslod IS NOT NULL THEN 'VQSLOD=' || CAST(vqslod AS VARCHAR) END,
          'AS_VQSLOD=' || array_to_string(list_transform(range(1, n + 1), lambda i: (vid * i) % 100), ',')) AS info
        FROM (SELECT *, len(string_split(alts, ',')) AS n FROM fx_sites)),
cell AS (
  SELECT st.vid, sm.ordinal,
         CASE WHEN c.vid IS NULL THEN './.:.:.:.' ELSE concat(
           CASE WHEN c.a1 IS NULL THEN './.' WHEN c.a2 IS NULL THEN CAST(c.a1 AS VARCHAR) ELSE concat(c.a1, '/', c.a2) END, ':',
           CASE WHEN c.ad0 IS NULL THEN '.' ELSE concat_ws(',', c.ad0, c.ad1, c.ad2, c.ad3) END, ':',
           CAST(c.gq AS VARCHAR), ':',
           array_to_string(list_transform(range(0, ((c.nalt + 1) * (c.nalt + 2)) // 2), lambda j: (c.pl_seed + 31 * j) % 100), ','))
         END AS txt
  FROM fx_sites st CROSS JOIN fx_samples sm
  LEFT JOIN fx_calls c ON c.vid = st.vid AND c.s = sm.s)
"""


@query("vcf_render", _with("fx_sites_t", "fx_calls_t", "fx_samples") + _twins(_RENDER_SQL + """
SELECT concat_ws(chr(9), st.contig, CAST(st.position AS VARCHAR), 'v' || CAST(st.vid AS VARCHAR), st.ref, st.alts, '.',
                 st.filter, inf.info, 'GT:AD:GQ:PL', g.txt) AS line
FROM fx_sites st JOIN inf ON st.vid = inf.vid
JOIN (SELECT vid, string_agg(txt, chr(9) ORDER BY ordinal) AS txt FROM cell GROUP BY vid) g ON st.vid = g.vid"""))
def q_vcf_render(spark, sf):
    s, c, smp = _fixture_vcf(spark, sf, twins=True)
    return KV.record_lines(s, c, smp).select("line")


def fixture_vcf_path(spark, sf):
    """The fixture call set written once per session as a VCF (text parts in
    coordinate order, header in the first) in the checkpoint folder."""
    def write(path):
        s, c, smp = _fixture_vcf(spark, sf)
        header = SV.parse_header_lines(FIXTURE_HEADER_LINES)
        header.samples = [r["s"] for r in smp.orderBy("ordinal").collect()]
        # plain text is splittable: the parse queries read it with full
        # parallelism (gzip / bgzip decoding is covered by tests/test_io.py)
        KV.write_vcf(spark, header, s, path, calls=c, samples=smp, compression="none")
    return IN.stored_path(spark, sf, "vcf", write)


def _parsed(spark, sf, drop_samples):
    return SV.read_vcf(spark, fixture_vcf_path(spark, sf), drop_samples=drop_samples)


@query("vcf_parse_sites", cte("fx_sites") + """
SELECT vid, contig, position, ref, alts, filter, vqslod AS VQSLOD,
       array_to_string(list_transform(range(1, len(string_split(alts, ',')) + 1), lambda i: (vid + 13 * i) % 200), ',') AS AC
FROM fx_sites""")
def q_vcf_parse_sites(spark, sf):
    v = _parsed(spark, sf, drop_samples=True)
    return v.sites.select(F.substring("rsid", 2, 20).cast("long").alias("vid"), "contig", "position",
                          F.col("alleles")[0].alias("ref"), F.array_join(F.slice("alleles", 2, F.size("alleles") - 1), ",").alias("alts"),
                          F.array_join("filters", ";").alias("filter"), F.col("info.VQSLOD").alias("VQSLOD"),
                          F.array_join("info.AC", ",").alias("AC"))


@query("vcf_parse_calls", cte("fx_sites", "fx_calls", "fx_samples") + """
SELECT st.contig, st.position, sm.s, c.a1 AS gt_a1, c.a2 AS gt_a2,
       CASE WHEN c.ad0 IS NULL THEN NULL ELSE concat_ws(',', c.ad0, c.ad1, c.ad2, c.ad3) END AS AD,
       c.gq AS GQ,
       CASE WHEN c.vid IS NULL THEN NULL ELSE
         array_to_string(list_transform(range(0, ((c.nalt + 1) * (c.nalt + 2)) // 2), lambda j: (c.pl_seed + 31 * j) % 100), ',') END AS PL
FROM fx_sites st CROSS JOIN fx_samples sm LEFT JOIN fx_calls c ON c.vid = st.vid AND c.s = sm.s""")
def q_vcf_parse_calls(spark, sf):
    v = _parsed(spark, sf, drop_samples=False)
    return v.calls.select("contig", "position", "s", F.col("GT.a1").alias("gt_a1"), F.col("GT.a2").alias("gt_a2"),
                          F.array_join("AD", ",").alias("AD"), "GQ", F.array_join("PL", ",").alias("PL"))


# ================================================================== pipelines
from lociframe.plans import extra as EX  # noqa: E402
from lociframe.plans import annotate as AT  # noqa: E402
from lociframe.session import spread_shuffles  # noqa: E402


def _extra_tables(spark, sf, with_splice=True):
    cv = _score_table(spark, sf, "fx_clinvar").withColumnRenamed("clnsig", "CLNSIG") \
        .withColumnRenamed("clnrevstat", "CLNREVSTAT")
    rv = fixture(spark, sf, "fx_revel").withColumnRenamed("chr", "#chr").withColumnRenamed("revel", "REVEL")
    sa = (LK.variant_key_of(fixture(spark, sf, "fx_spliceai"))
          .withColumnRenamed("symbol", "SYMBOL").withColumnRenamed("spliceai", "SpliceAI")) if with_splice else None
    return EX.ExtraTables(
        mpc=_score_table(spark, sf, "fx_mpc"), revel=rv, clinvar=cv,
        loeuf_v2=fixture(spark, sf, "fx_genes"), loeuf_v4=_genes_v4(spark, sf), omim=fixture(spark, sf, "fx_omim"),
        gene_lists=[("genes_a.txt", fixture(spark, sf, "fx_gene_list")),
                    ("genes_b.txt", fixture(spark, sf, "fx_gene_list_b"))],
        spliceai=sa, intervals=fixture(spark, sf, "fx_intervals"))


_EXTRA_SQL = f"""
mp AS {_first_by('fx_mpc', 'contig, position, ref, alt', 'mpc')},
cv AS {_first_by('fx_clinvar', 'contig, position, ref, alt', 'clnsig, clnrevstat')},
rv0 AS (SELECT concat('chr', chr) AS contig, TRY_CAST(grch38_pos AS BIGINT) AS position, ref, alt, revel FROM fx_revel),
rv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contig, position, ref, alt ORDER BY revel) AS rn
                      FROM rv0 WHERE position IS NOT NULL) WHERE rn = 1),
g2 AS {_first_by('fx_genes', 'transcript', 'oe_lof_upper, oe_lof_upper_bin')},
g4 AS {_first_by('fx_genes_v4', 'transcript', 'lof_upper, lof_decile')},
tx AS (SELECT DISTINCT s.contig, s.position, s.ref, s.alt, s.vid, c.ord, c.symbol, c.feature, c.consequence, c.hgvsc, c.hgvsp
       FROM split s JOIN fx_csq c ON s.vid = c.vid),
ent AS (
  SELECT tx.contig, tx.position, tx.ref, tx.alt, tx.ord,
         tx.symbol || '|' || tx.feature || '|' || tx.consequence || '|' || tx.hgvsc || '|' || tx.hgvsp
         || '|' || CASE WHEN g2.transcript IS NULL THEN '' ELSE g2.oe_lof_upper END
         || '|' || CASE WHEN g2.transcript IS NULL THEN '' ELSE g2.oe_lof_upper_bin END
         || '|' || CASE WHEN g4.transcript IS NULL THEN '' ELSE g4.lof_upper END
         || '|' || CASE WHEN g4.transcript IS NULL THEN '' ELSE g4.lof_decile END
         || '|' || coalesce(om.mimNumber, '') || '|' || coalesce(om.inheritance_code, '')
         || '|' || concat_ws('&', CASE WHEN tx.symbol IN (SELECT symbol FROM fx_gene_list) THEN 'genes_a.txt' END,
                                  CASE WHEN tx.symbol IN (SELECT symbol FROM fx_gene_list_b) THEN 'genes_b.txt' END)
         || '|' || {" || '|' || ".join(
             f"CASE WHEN sa.spliceai IS NULL THEN '' ELSE string_split(string_split(sa.spliceai, '=')[2], '|')[{i + 3}] END"
             for i in range(8))} AS e
  FROM tx LEFT JOIN g2 ON tx.feature = g2.transcript LEFT JOIN g4 ON tx.feature = g4.transcript
  LEFT JOIN fx_omim om ON tx.symbol = om.approvedGeneSymbol
  LEFT JOIN fx_spliceai sa ON tx.contig = sa.contig AND tx.position = sa.position AND tx.ref = sa.ref
                           AND tx.alt = sa.alt AND tx.symbol = sa.symbol),
packed AS (SELECT contig, position, ref, alt, string_agg(e, ',' ORDER BY ord, e) AS csq FROM ent
           GROUP BY contig, position, ref, alt)
"""


ENTRY_SPREAD = 8     # entries with their scores, sorted, are that much larger than what they are derived from


@query("annotate_extra", _with("fx_sites", "fx_csq", "fx_mpc", "fx_clinvar", "fx_revel", "fx_genes",
                                        "fx_genes_v4", "fx_omim", "fx_gene_list", "fx_gene_list_b", "fx_spliceai",
                                        "fx_intervals") + _SPLIT_SQL + "," + _IV_HITS + "," + _EXTRA_SQL + """
SELECT s.vid, s.a_index, mp.mpc AS MPC, cv.clnsig AS CLNSIG, cv.clnrevstat AS CLNREVSTAT, rv.revel AS REVEL,
       h.target AS PREDICTED_NONCODING, p.csq AS CSQ
FROM split s
LEFT JOIN mp ON s.contig = mp.contig AND s.position = mp.position AND s.ref = mp.ref AND s.alt = mp.alt
LEFT JOIN cv ON s.contig = cv.contig AND s.position = cv.position AND s.ref = cv.ref AND s.alt = cv.alt
LEFT JOIN rv ON s.contig = rv.contig AND s.position = rv.position AND s.ref = rv.ref AND s.alt = rv.alt
LEFT JOIN hits h ON s.vid = h.vid AND s.a_index = h.a_index AND h.rn = 1
LEFT JOIN packed p ON s.contig = p.contig AND s.position = p.position AND s.ref = p.ref AND s.alt = p.alt""")
def q_annotate_extra(spark, sf):
    """Flagship: the whole extra-annotation chain on split, annotated sites."""
    s = _split_sites(spark, sf, with_csq=True)
    tables = _extra_tables(spark, sf)
    spread_shuffles(spark, ENTRY_SPREAD * IN.table_bytes(spark, sf))
    out, _ = EX.annotate_extra(s, IN.CSQ_DESCRIPTION, tables)
    return out.select("vid", "a_index", *[F.col(f"info.{c}").alias(c) for c in
                                          ("MPC", "CLNSIG", "CLNREVSTAT", "REVEL", "PREDICTED_NONCODING", "CSQ")])


@query("annotate_extra_mt", _with("fx_sites", "fx_csq", "fx_mpc", "fx_clinvar", "fx_revel", "fx_genes",
                                  "fx_genes_v4", "fx_omim", "fx_gene_list", "fx_gene_list_b", "fx_spliceai",
                                  "fx_intervals") + _SPLIT_SQL + "," + _IV_HITS + "," + _EXTRA_SQL + """,
ents AS (SELECT contig, position, ref, alt, e, row_number() OVER (PARTITION BY contig, position, ref, alt ORDER BY ord, e) - 1 AS k
         FROM ent)
SELECT s.vid, s.a_index, CAST(x.k AS INT) AS k, x.e AS entry
FROM split s JOIN ents x ON s.contig = x.contig AND s.position = x.position AND s.ref = x.ref AND s.alt = x.alt""")
def q_annotate_extra_mt(spark, sf):
    """Matrix-table form: packed entries kept as an array (one row per entry here)."""
    s = _split_sites(spark, sf, with_csq=True)
    tables = _extra_tables(spark, sf)
    spread_shuffles(spark, ENTRY_SPREAD * IN.table_bytes(spark, sf))
    out, _ = EX.annotate_extra(s, IN.CSQ_DESCRIPTION, tables, as_array=True)
    return out.select("vid", "a_index", F.posexplode("info.CSQ").alias("k", "entry"))


def _consequence_table(spark, sf):
    s = IN.sites(spark, sf, with_csq=True)
    sp = SP.split_multi(s)
    return sp.select("contig", "position", "alleles", F.array_join("info.CSQ", ",").alias("CSQ")) \
             .where(F.col("CSQ").isNotNull())


@query("annotate_vcf", _with("fx_sites", "fx_calls", "fx_csq") + _SPLIT_SQL + "," + _CALLS_SQL + f"""
, st AS (SELECT vid, a_index, sum(coalesce(g1, 0) + coalesce(g2, 0)) AS ac,
                sum(CASE WHEN g1 IS NULL THEN 0 WHEN g2 IS NULL THEN 1 ELSE 2 END) AS an FROM cs GROUP BY vid, a_index),
pk AS (SELECT vid, string_agg({_ENTRY_SQL}, ',' ORDER BY ord) AS csq FROM fx_csq GROUP BY vid),
keyed AS (SELECT s.contig, s.position, s.ref, s.alt, min(pk.csq) AS csq FROM split s JOIN pk ON s.vid = pk.vid
          GROUP BY s.contig, s.position, s.ref, s.alt)
SELECT s.vid, s.a_index, CAST(coalesce(st.ac, 0) AS INT) AS cohort_AC,
       CASE WHEN coalesce(st.an, 0) = 0 THEN NULL ELSE CAST(st.ac AS DOUBLE) / st.an END AS cohort_AF,
       CAST((s.vid * s.a_index) % 100 AS INT) AS VQSLOD, k.csq AS CSQ
FROM split s LEFT JOIN st ON s.vid = st.vid AND s.a_index = st.a_index
LEFT JOIN keyed k ON s.contig = k.contig AND s.position = k.position AND s.ref = k.ref AND s.alt = k.alt""".replace("\n,", ","))
def q_annotate_vcf(spark, sf):
    """Consequence annotation chain: split, AC/AF (recomputed from calls),
    allele-specific backfill, consequences joined by variant."""
    s = IN.sites(spark, sf)
    out = AT.annotate_sites(s, IN.calls(spark, sf, s), reannotate_ac_af=True,
                            consequences=_consequence_table(spark, sf))
    return out.select("vid", "a_index", F.col("info.cohort_AC").alias("cohort_AC"),
                      F.col("info.cohort_AF").alias("cohort_AF"), F.col("info.VQSLOD").alias("VQSLOD"),
                      F.col("info.CSQ").alias("CSQ"))


# ================================================================== BED, plugin scores, samples
from lociframe.sources import tables as TB  # noqa: E402


@query("bed_read", cte("fx_intervals") + """
SELECT contig, start0, end0, target FROM fx_intervals""")
def q_bed_read(spark, sf):
    """BED text (header line, valid and invalid intervals) -> valid intervals."""
    iv = fixture(spark, sf, "fx_intervals")
    good = iv.select(F.concat_ws("\t", "contig", F.col("start0").cast("string"), F.col("end0").cast("string"),
                                 "target").alias("value"))
    # every tenth interval again with start and end swapped: invalid, skipped
    bad = iv.where(F.col("target").endswith("0")).select(
        F.concat_ws("\t", "contig", F.col("end0").cast("string"), F.col("start0").cast("string"), "target").alias("value"))
    head = spark.createDataFrame([("chrom\tstart\tend\tname",)], "value string")
    return TB.parse_bed_lines(head.unionByName(good).unionByName(bad), build="GRCh38")


@query("plugin_scores", _with("fx_sites", "fx_csq", "fx_plugin") + _SPLIT_SQL + f"""
SELECT s.vid, s.a_index, c.ord, pl.am_score AS am_score
FROM split s JOIN fx_csq c ON s.vid = c.vid
LEFT JOIN {_first_by('fx_plugin', 'contig, position, ref, alt, transcript', 'am_score')} pl
  ON s.contig = pl.contig AND s.position = pl.position AND s.ref = pl.ref AND s.alt = pl.alt AND c.feature = pl.transcript""")
def q_plugin_scores(spark, sf):
    t = LK.variant_key_of(fixture(spark, sf, "fx_plugin"))
    e = PK.entry_lookup(_flat(spark, sf, split=True), t, {"am_score": "am_score"})
    return e.select("vid", "a_index", F.col("csq_pos").alias("ord"), F.col("t_am_score").alias("am_score"))


@query("sample_count", cte("fx_samples") + """
SELECT count(DISTINCT s) AS n_samples FROM fx_samples""")
def q_sample_count(spark, sf):
    """From the header of the call set; the calls are not read."""
    return CT.sample_count(SV.samples_frame(spark, SV.read_header(spark, fixture_vcf_path(spark, sf))))


# ================================================================== text forms of a call set
from lociframe.operators import header as HD  # noqa: E402
from lociframe.sinks import blocks as KB  # noqa: E402

_HEAD_COLUMNS = "#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT".split()


def _header(spark, sf, lines=FIXTURE_HEADER_LINES):
    h = SV.parse_header_lines(lines)
    h.samples = [r["s"] for r in fixture(spark, sf, "fx_samples").orderBy("ordinal").collect()]
    return h


@query("vcf_find_replace", cte("fx_sites") + """
SELECT vid, CASE filter WHEN 'LowQual' THEN 'PASS' ELSE filter END AS filter, vqslod AS VQSLOD FROM fx_sites""")
def q_vcf_find_replace(spark, sf):
    """Text replaced in the raw lines before they are parsed."""
    v = SV.read_vcf(spark, fixture_vcf_path(spark, sf), drop_samples=True, find_replace=("\\tLowQual\\t", "\tPASS\t"))
    return v.sites.select(F.substring("rsid", 2, 20).cast("long").alias("vid"), F.array_join("filters", ";").alias("filter"),
                          F.col("info.VQSLOD").alias("VQSLOD"))


@query("vcf_block_read", cte("fx_sites") + """
SELECT vid, contig, position, ref, alts, filter FROM fx_sites""")
def q_vcf_block_read(spark, sf):
    """The fixture call set written as block gzip and read by byte ranges."""
    def write(path):
        KB.write_block_gzip(spark.read.text(fixture_vcf_path(spark, sf)), path).count()
    path = IN.stored_path(spark, sf, "vcf-blocks", write)
    lines = SV.BL.read_ranges(spark, SV.BL.list_files(spark, path), range_bytes=1 << 16)
    sites = SV.parse_sites(lines, SV.read_header(spark, fixture_vcf_path(spark, sf)))
    return sites.select(F.substring("rsid", 2, 20).cast("long").alias("vid"), "contig", "position", F.col("alleles")[0].alias("ref"),
                        F.array_join(F.slice("alleles", 2, F.size("alleles") - 1), ",").alias("alts"), F.array_join("filters", ";").alias("filter"))


@query("vcf_bgz_file", cte("fx_sites") + """
SELECT vid, contig, position, ref, alts, filter FROM fx_sites""")
def q_vcf_bgz_file(spark, sf):
    """The fixture call set as one block-gzip file, joined from parts, and read
    by byte ranges."""
    def write(path):
        s, c, smp = _fixture_vcf(spark, sf)
        KV.write_vcf_bgz(spark, _header(spark, sf), s, f"{path}/all.vcf.bgz", f"{path}-parts", calls=c, samples=smp)
    path = IN.stored_path(spark, sf, "vcf-bgz", write)
    lines = SV.BL.read_ranges(spark, SV.BL.list_files(spark, f"{path}/all.vcf.bgz"), range_bytes=1 << 16)
    sites = SV.parse_sites(lines, SV.read_header(spark, f"{path}/all.vcf.bgz"))
    return sites.select(F.substring("rsid", 2, 20).cast("long").alias("vid"), "contig", "position", F.col("alleles")[0].alias("ref"),
                        F.array_join(F.slice("alleles", 2, F.size("alleles") - 1), ",").alias("alts"), F.array_join("filters", ";").alias("filter"))


@query("header_fields", cte("fx_samples") + """
SELECT * FROM (VALUES
  ('INFO', 'AC', 'A', 'Integer', 'Allele count'), ('INFO', 'AF', 'A', 'Float', 'Allele frequency'),
  ('INFO', 'VQSLOD', '1', 'Integer', 'Site log-odds'), ('INFO', 'AS_VQSLOD', 'A', 'Integer', 'Allele-specific log-odds'),
  ('INFO', 'CSQ', '.', 'String', 'Consequence annotations. Format: SYMBOL|Feature|Consequence|HGVSc|HGVSp'),
  ('FORMAT', 'GT', '1', 'String', 'Genotype'), ('FORMAT', 'AD', 'R', 'Integer', 'Allelic depths'),
  ('FORMAT', 'GQ', '1', 'Integer', 'Genotype quality'), ('FORMAT', 'PL', 'G', 'Integer', 'Phred-scaled likelihoods'),
  ('FILTER', 'PASS', NULL, NULL, 'All filters passed'), ('FILTER', 'LowQual', NULL, NULL, 'Low quality'),
  ('FILTER', 'extra', NULL, NULL, 'Added line'),
  ('FILTER', 'NO_HQ_GENOTYPES', NULL, NULL, 'Sites with this filter do not have any genotypes that are considered high quality')
) t(section, id, number, type, description)
UNION ALL SELECT 'SAMPLE' AS section, s AS id, CAST(ordinal AS VARCHAR) AS number, NULL AS type, NULL AS description FROM fx_samples""")
def q_header_fields(spark, sf):
    """The header read from the call set's own files, an INFO field declared,
    FILTER lines appended (a known id keeps its text), merge filters added."""
    h = SV.read_header(spark, fixture_vcf_path(spark, sf))
    h = HD.set_field(h, "INFO", "CSQ", ".", "String", IN.CSQ_DESCRIPTION)
    h = HD.append_filter_lines(h, ['##FILTER=<ID=extra,Description="Added line">', '##FILTER=<ID=LowQual,Description="Other">'])
    h = HD.add_merge_filters(h)
    none = F.lit(None).cast("string")
    samples = SV.samples_frame(spark, h).select(F.lit("SAMPLE").alias("section"), F.col("s").alias("id"), F.col("ordinal").cast("string").alias("number"),
                                                none.alias("type"), none.alias("description"))
    return SV.header_frame(spark, h).unionByName(samples)


@query("csq_description", _with("fx_csq") + """
names AS (SELECT string_split('SYMBOL|Feature|Consequence|HGVSc|HGVSp', '|') AS f)
SELECT f[i] AS field, count(*) FILTER (string_split(concat(symbol, '|', feature, '|', consequence, '|', hgvsc, '|', hgvsp), '|')[i] <> '') AS n_filled
FROM names, range(1, 6) r(i), fx_csq GROUP BY field""")
def q_csq_description(spark, sf):
    """Field names from the header description decide where each value of a
    packed entry goes: filled values per field."""
    fields = PK.fields_from_description(IN.CSQ_DESCRIPTION)
    entries = IN.sites(spark, sf, with_csq=True).select(F.explode("info.CSQ").alias("e"))
    parts = F.split("e", r"\|", -1)
    filled = entries.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), (F.get(parts, i) != "").alias("there"))
                                                for i, f in enumerate(fields)])).alias("x")).select("x.*")
    return filled.groupBy("field").agg(F.count_if("there").alias("n_filled"))


@query("csq_extended", _with("fx_csq", "fx_genes") + """
e AS (SELECT c.symbol, c.feature, c.consequence, c.hgvsc, c.hgvsp, coalesce(g.oe_lof_upper, '') AS upper, coalesce(g.oe_lof_upper_bin, '') AS bin
      FROM fx_csq c LEFT JOIN fx_genes g ON g.transcript = c.feature),
names AS (SELECT string_split('SYMBOL|Feature|Consequence|HGVSc|HGVSp|LOEUF_v2|LOEUF_v2_decile', '|') AS f)
SELECT i AS place, f[i] AS field, count(*) FILTER (string_split(concat_ws('|', symbol, feature, consequence, hgvsc, hgvsp, upper, bin), '|')[i] <> '') AS n_filled
FROM names, range(1, 8) r(i), e GROUP BY place, field""")
def q_csq_extended(spark, sf):
    """The description extended by new packed fields names the places where the
    repacked entries hold them: filled values per place and field."""
    sites, new = IN.sites(spark, sf, with_csq=True), ["LOEUF_v2", "LOEUF_v2_decile"]
    fields = PK.fields_from_description(IN.CSQ_DESCRIPTION)
    key = ["record", "contig", "position", "alleles"]
    e = PK.explode_packed(sites, F.col("info.CSQ"), fields, key)
    e = LK.lookup(e, fixture(spark, sf, "fx_genes"), {"transcript": F.col("t_Feature")},
                  {"t_LOEUF_v2": "oe_lof_upper", "t_LOEUF_v2_decile": "oe_lof_upper_bin"}, default="")
    packed = PK.regroup(e, fields + new, key=key, as_array=True, out="CSQ")
    extended = PK.fields_from_description(PK.extend_description(IN.CSQ_DESCRIPTION, new))
    parts = F.split(F.col("entry"), r"\|", -1)
    filled = packed.select(F.explode("CSQ").alias("entry")).select(F.explode(F.array(*[
        F.struct(F.lit(i + 1).cast("long").alias("place"), F.lit(f).alias("field"), (F.get(parts, i) != "").alias("there"))
        for i, f in enumerate(extended)])).alias("x")).select("x.*")
    return filled.groupBy("place", "field").agg(F.count_if("there").alias("n_filled"))


_SHARD_OF = """
placed AS (SELECT vid, concat(contig, '_', CAST((rn - min(rn) OVER (PARTITION BY contig)) // 200 AS VARCHAR)) AS shard FROM (
  SELECT vid, contig, row_number() OVER (ORDER BY {order}, position, ref, alts) AS rn FROM fx_sites))
"""


@query("vcf_shards", _with("fx_sites_t", "fx_calls_t", "fx_samples") + _twins(_RENDER_SQL + "," + _SHARD_OF.format(order=_CONTIG_ORD) + """
SELECT p.shard, concat_ws(chr(9), st.contig, CAST(st.position AS VARCHAR), 'v' || CAST(st.vid AS VARCHAR), st.ref, st.alts, '.',
                          st.filter, inf.info, 'GT:AD:GQ:PL', g.txt) AS line
FROM fx_sites st JOIN inf ON st.vid = inf.vid JOIN placed p ON p.vid = st.vid
JOIN (SELECT vid, string_agg(txt, chr(9) ORDER BY ordinal) AS txt FROM cell GROUP BY vid) g ON st.vid = g.vid
UNION ALL
SELECT shard, (SELECT concat('#CHROM	POS	ID	REF	ALT	QUAL	FILTER	INFO	FORMAT	', string_agg(s, chr(9) ORDER BY ordinal)) FROM fx_samples)
FROM (SELECT DISTINCT shard FROM placed)"""))
def q_vcf_shards(spark, sf):
    """Shards written as VCF folders and read back: records that share a key
    stay in their own shard once, every shard has its header."""
    def write(path):
        s, c, smp = _fixture_vcf(spark, sf, twins=True)
        sharded = SH.shard_by_contig(s, "GRCh38", 200)
        KV.write_vcf_shards(spark, _header(spark, sf), sharded, "shard", path, calls=c, samples=smp, compression="none")
    lines = spark.read.text(IN.stored_path(spark, sf, "vcf-shards", write))
    return lines.where(~F.col("value").startswith("##")).select(F.col("shard").cast("string").alias("shard"), F.col("value").alias("line"))


@query("vcf_after_split", _with("fx_sites_t", "fx_calls_t", "fx_samples") + _twins(_SPLIT_SQL + "," + _CALLS_SQL + """,
cell AS (
  SELECT sp.vid, sp.a_index, sm.ordinal, CASE WHEN p.vid IS NULL THEN './.:.:.:.' ELSE concat(
           CASE WHEN p.g1 IS NULL THEN './.' ELSE concat(p.g1, '/', coalesce(p.g2, p.g1)) END, ':',
           CASE WHEN p.ad_alt IS NULL THEN '.' ELSE concat(p.ad_ref, ',', p.ad_alt) END, ':', CAST(c.gq AS VARCHAR), ':',
           concat(p.pl0, ',', p.pl1, ',', p.pl2)) END AS txt
  FROM split sp CROSS JOIN fx_samples sm LEFT JOIN pl p ON p.vid = sp.vid AND p.a_index = sp.a_index AND p.s = sm.s
  LEFT JOIN fx_calls c ON c.vid = sp.vid AND c.s = sm.s)
SELECT concat_ws(chr(9), sp.contig, CAST(sp.position AS VARCHAR), concat('v', CAST(sp.vid AS VARCHAR), '_', CAST(sp.a_index AS VARCHAR)), sp.ref,
                 sp.alt, '.', '.', '.', 'GT:AD:GQ:PL', g.txt) AS line
FROM split sp JOIN (SELECT vid, a_index, string_agg(txt, chr(9) ORDER BY ordinal) AS txt FROM cell GROUP BY vid, a_index) g
  ON g.vid = sp.vid AND g.a_index = sp.a_index"""))
def q_vcf_after_split(spark, sf):
    """The split call set as VCF records, also where two share a key."""
    s = SP.split_multi(IN.sites(spark, sf, twins=True))
    s = s.withColumn("rsid", F.concat(F.lit("v"), F.col("vid").cast("string"), F.lit("_"), F.col("a_index").cast("string")))
    c = GT.haploid_to_diploid(SP.split_calls(IN.calls(spark, sf, twins=True)))
    out = KV.record_lines(s.drop("vid", "info", "filters"), c.drop("vid"), fixture(spark, sf, "fx_samples"))
    return out.select("line")


@query("union_keyed_tables", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS brand FROM customer
UNION ALL
SELECT p_partkey AS key, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS balance, p_brand AS brand FROM part""")
def q_union_keyed_tables(spark, sf):
    """Stored keyed tables read, united by name and stored again."""
    def write(path):
        cust = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                                                   F.col("c_acctbal").alias("balance"))
        part = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"))
        MG.union_tables([cust, part]).write.mode("overwrite").parquet(path)
    return spark.read.parquet(IN.stored_path(spark, sf, "keyed-union", write))


@query("clinvar_vcf", ORACLES["lookup_clinvar"])
def q_clinvar_vcf(spark, sf):
    """ClinVar read from a VCF (contigs without ``chr``), whole value arrays."""
    def write(path):
        cv = fixture(spark, sf, "fx_clinvar")
        info = F.concat(F.lit("CLNSIG="), "clnsig", F.lit(";CLNREVSTAT="), "clnrevstat")
        body = cv.select(F.concat_ws("\t", F.substring("contig", 4, 9), F.col("position").cast("string"), F.lit("."), "ref", "alt", F.lit("."),
                                     F.lit("."), info).alias("value"))
        head = spark.createDataFrame([(x,) for x in (
            "##fileformat=VCFv4.2", '##INFO=<ID=CLNSIG,Number=.,Type=String,Description="Significance">',
            '##INFO=<ID=CLNREVSTAT,Number=.,Type=String,Description="Review status">', "\t".join(_HEAD_COLUMNS[:8]))], "value string").coalesce(1)
        head.unionByName(body).write.mode("overwrite").text(path)
    table = LK.clinvar_from_vcf(spark, IN.stored_path(spark, sf, "clinvar-vcf", write))
    out = LK.clinvar_lookup(_split_sites(spark, sf), table, "GRCh38")
    return out.select("vid", "a_index", F.array_join("info.CLNSIG", ",").alias("CLNSIG"), F.array_join("info.CLNREVSTAT", ",").alias("CLNREVSTAT"))


@query("annotate_keep_earlier", _with("fx_sites", "fx_csq") + _SPLIT_SQL + f""",
pk AS (SELECT vid, string_agg({_ENTRY_SQL}, ',' ORDER BY ord) AS csq FROM fx_csq GROUP BY vid)
SELECT s.vid, s.a_index, pk.csq AS earlier, CASE WHEN pk.csq IS NOT NULL THEN concat('new:', s.ref, '>', s.alt) END AS CSQ
FROM split s LEFT JOIN pk ON s.vid = pk.vid""")
def q_annotate_keep_earlier(spark, sf):
    """A new annotation replaces the one that is there, which is kept beside it."""
    s = IN.sites(spark, sf, with_csq=True)
    new = SP.split_multi(s).where(F.col("info.CSQ").isNotNull()).select(
        "contig", "position", "alleles", F.concat(F.lit("new:"), F.array_join("alleles", ">")).alias("CSQ"))
    out = AT.annotate_sites(s, consequences=new, keep_earlier=True)
    return out.select("vid", "a_index", F.array_join("info.CSQ_earlier", ",").alias("earlier"), F.col("info.CSQ").alias("CSQ"))
