"""Fixture views: variant-shaped test inputs derived from the driver tables.

Each view is plain SQL that Spark and DuckDB both accept unchanged, so the
same text serves as a Spark temp view and as a CTE of an oracle query.  The
first seven are the views defined in FIXTURES.md; the rest are the "derived
inputs" it asks for, written in the same style (integer arithmetic only, no
randomness).  Fixtures build *inputs*; the operators under test never use
this SQL, and the oracles re-derive every result independently.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# The seven fixture views of FIXTURES.md, verbatim.
FIXTURE_SQL: dict[str, str] = {
    "fx_sites": """
SELECT o_orderkey AS vid,
       concat('chr', CAST(1 + o_custkey % 22 AS VARCHAR(8))) AS contig,
       CAST(1000 + (o_orderkey * 7919) % 1000003 AS BIGINT) AS position,
       CASE o_orderkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'GT' WHEN 3 THEN 'T' ELSE 'GA' END AS ref,
       CASE o_orderkey % 7 WHEN 0 THEN 'G,ATC' WHEN 1 THEN 'G' WHEN 2 THEN 'GTT' WHEN 3 THEN 'A,*' WHEN 4 THEN 'TA,GAA,C' WHEN 5 THEN 'CT' ELSE 'AC' END AS alts,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'PASS' ELSE 'LowQual' END AS filter,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(NULL AS INT) ELSE CAST(o_orderkey % 100 AS INT) END AS vqslod
FROM orders""",
    "fx_calls": """
SELECT vid, concat('S', CAST(ln AS VARCHAR(8))) AS s,
       CASE WHEN pk % 11 = 0 THEN CAST(NULL AS INT) ELSE CAST(pk % (nalt + 1) AS INT) END AS a1,
       CASE WHEN pk % 11 = 0 OR (vid % 22 = 3 AND ln = 1) THEN CAST(NULL AS INT)
            ELSE CAST(pk % (nalt + 1) + sk % (nalt + 1 - pk % (nalt + 1)) AS INT) END AS a2,
       CASE WHEN pk % 13 = 0 THEN CAST(NULL AS INT) ELSE CAST(sk % 40 AS INT) END AS ad0,
       CASE WHEN pk % 13 = 0 THEN CAST(NULL AS INT) ELSE CAST((sk + 17) % 40 AS INT) END AS ad1,
       CASE WHEN pk % 13 = 0 OR nalt < 2 THEN CAST(NULL AS INT) ELSE CAST((sk + 34) % 40 AS INT) END AS ad2,
       CASE WHEN pk % 13 = 0 OR nalt < 3 THEN CAST(NULL AS INT) ELSE CAST((sk + 51) % 40 AS INT) END AS ad3,
       CAST(pk % 100 AS INT) AS pl_seed, CAST(gq AS INT) AS gq, CAST(nalt AS INT) AS nalt
FROM (SELECT l_orderkey AS vid, l_linenumber AS ln, min(l_partkey) AS pk, min(l_suppkey) AS sk, max(l_quantity) * 2 AS gq,
             CASE l_orderkey % 7 WHEN 0 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 1 END AS nalt
      FROM lineitem GROUP BY l_orderkey, l_linenumber) g""",
    "fx_csq": """
SELECT l_orderkey AS vid, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS INT) AS ord,
       concat('GENE', CAST(l_partkey % 200 AS VARCHAR(8))) AS symbol,
       concat('ENST', CAST(l_partkey AS VARCHAR(8))) AS feature,
       CASE l_returnflag WHEN 'R' THEN 'missense_variant&splice_region_variant' WHEN 'A' THEN 'synonymous_variant' ELSE 'stop_gained' END AS consequence,
       CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat('ENST', CAST(l_partkey AS VARCHAR(8)), ':c.', CAST(l_suppkey AS VARCHAR(8)), 'A>G') END AS hgvsc,
       CASE WHEN l_partkey % 2 = 0 THEN '' ELSE concat('ENSP', CAST(l_partkey AS VARCHAR(8)), ':p.Arg', CAST(l_suppkey AS VARCHAR(8)), 'Gly') END AS hgvsp
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem) d""",
    "fx_genes": """
SELECT concat('ENST', CAST(p_partkey AS VARCHAR(8))) AS transcript, concat('GENE', CAST(p_partkey % 200 AS VARCHAR(8))) AS symbol,
       CAST(p_size AS VARCHAR(8)) AS oe_lof_upper, CAST(p_size % 10 AS VARCHAR(8)) AS oe_lof_upper_bin
FROM part WHERE p_partkey % 4 <> 0""",
    "fx_intervals": """
SELECT concat('chr', CAST(1 + s_nationkey % 22 AS VARCHAR(8))) AS contig, CAST((s_suppkey * 99991) % 1000003 AS BIGINT) AS start0,
       CAST((s_suppkey * 99991) % 1000003 + 20000 AS BIGINT) AS end0, concat('elem_', CAST(s_suppkey AS VARCHAR(8))) AS target
FROM supplier""",
    "fx_pedigree": """
SELECT concat('F', CAST(c_custkey % 300 AS VARCHAR(8))) AS family_id, c_name AS sample_id,
       CAST(1 + c_custkey % 2 AS INT) AS sex, CAST(1 + c_nationkey % 2 AS INT) AS phenotype
FROM customer""",
    "fx_loadings": """
SELECT o.o_orderkey AS vid, e.embedding AS loadings,
       CAST(0.05 + (o.o_orderkey % 90) / 100.0 AS DOUBLE) AS pca_af
FROM orders o JOIN embeddings e ON o.o_orderkey = e.vec_id""",
    # ---- derived inputs (same style) ----
    # twins: a record that shares a variant key, once split, with a
    # multi-allelic one (its first ALT written again as a record of its own)
    "fx_sites_t": """
SELECT vid, contig, position, ref, alts, filter, vqslod FROM fx_sites
UNION ALL
SELECT vid + 1000000000 AS vid, contig, position, ref, split_part(alts, ',', 1) AS alts, filter, vqslod FROM fx_sites
WHERE alts LIKE '%,%' AND vid % 10 = 0""",
    "fx_calls_t": """
SELECT vid, s, a1, a2, ad0, ad1, ad2, ad3, pl_seed, gq, nalt FROM fx_calls
UNION ALL
SELECT vid + 1000000000 AS vid, s, CASE WHEN a1 > 1 THEN 1 ELSE a1 END AS a1, CASE WHEN a2 > 1 THEN 1 ELSE a2 END AS a2, ad0, ad1,
       CAST(NULL AS INT) AS ad2, CAST(NULL AS INT) AS ad3, pl_seed, gq, CAST(1 AS INT) AS nalt FROM fx_calls
WHERE nalt > 1 AND vid % 10 = 0""",
    # one row per ALT of a record, as written (no trimming): the key shape of
    # the score tables below
    "fx_alleles": """
SELECT vid, contig, position, ref, 1 AS a_index, split_part(alts, ',', 1) AS alt FROM fx_sites
UNION ALL
SELECT vid, contig, position, ref, 2 AS a_index, split_part(alts, ',', 2) AS alt FROM fx_sites WHERE alts LIKE '%,%'
UNION ALL
SELECT vid, contig, position, ref, 3 AS a_index, split_part(alts, ',', 3) AS alt FROM fx_sites WHERE alts LIKE '%,%,%'""",
    # MPC-like, keyed (contig, position, ref, alt); every 30th vid carries a
    # duplicate key with another score, to prove lookups never multiply rows
    "fx_mpc": """
SELECT contig, position, ref, alt, CAST((vid * 7 + a_index) % 50 AS DOUBLE) / 10 AS mpc FROM fx_alleles WHERE vid % 3 = 0
UNION ALL
SELECT contig, position, ref, alt, CASE WHEN vid % 60 = 0 THEN -1.0 ELSE 99.0 END AS mpc FROM fx_alleles WHERE vid % 30 = 0""",
    "fx_clinvar": """
SELECT contig, position, ref, alt,
       CASE vid % 3 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Benign' ELSE 'Uncertain_significance' END AS clnsig,
       CASE WHEN vid % 2 = 0 THEN 'criteria_provided' ELSE 'no_assertion' END AS clnrevstat
FROM fx_alleles WHERE vid % 5 = 0
UNION ALL
SELECT contig, position, ref, alt, 'Conflicting' AS clnsig, 'reviewed' AS clnrevstat FROM fx_alleles WHERE vid % 50 = 0""",
    # REVEL-like: every column text, contig without 'chr', two positions,
    # GRCh38 position '.' on every 10th vid
    "fx_revel": """
SELECT substr(contig, 4) AS chr, CAST(position + 17 AS VARCHAR(12)) AS hg19_pos,
       CASE WHEN vid % 10 = 0 THEN '.' ELSE CAST(position AS VARCHAR(12)) END AS grch38_pos,
       ref, alt, concat('0.', lpad(CAST(vid % 1000 AS VARCHAR(8)), 3, '0')) AS revel
FROM fx_alleles WHERE vid % 7 = 0""",
    # gene constraint v4 (dotted column names are applied on the Spark side)
    "fx_genes_v4": """
SELECT concat('ENST', CAST(p_partkey AS VARCHAR(8))) AS transcript,
       CAST(p_size % 13 AS VARCHAR(8)) AS lof_upper, CAST(p_size % 10 AS VARCHAR(8)) AS lof_decile
FROM part WHERE p_partkey % 3 <> 0
UNION ALL
SELECT concat('ENST', CAST(p_partkey AS VARCHAR(8))) AS transcript, 'x' AS lof_upper, '0' AS lof_decile
FROM part WHERE p_partkey % 50 = 1""",
    "fx_omim": """
SELECT symbol AS approvedGeneSymbol, CAST(600000 + count(*) AS VARCHAR(12)) AS mimNumber,
       CASE WHEN max(oe_lof_upper_bin) < '5' THEN 'AD' ELSE 'AR' END AS inheritance_code
FROM fx_genes WHERE symbol NOT LIKE '%3' GROUP BY symbol""",
    "fx_gene_list": """
SELECT DISTINCT symbol FROM fx_genes WHERE symbol LIKE '%7'""",
    "fx_gene_list_b": """
SELECT DISTINCT symbol FROM fx_genes WHERE symbol LIKE '%1%'""",
    "fx_spliceai": """
SELECT a.contig, a.position, a.ref, a.alt, c.symbol,
       concat('SpliceAI=', a.alt, '|', c.symbol, '|0.', CAST(min(c.ord) % 10 AS VARCHAR(8)), '|0.', CAST(count(*) % 10 AS VARCHAR(8)),
              '|0.0', CAST(a.a_index AS VARCHAR(8)), '|0.00|', CAST(min(c.ord) - 5 AS VARCHAR(8)), '|', CAST(a.a_index * 3 AS VARCHAR(8)),
              '|-1|2') AS spliceai
FROM fx_alleles a JOIN fx_csq c ON a.vid = c.vid
WHERE a.vid % 4 = 1
GROUP BY a.contig, a.position, a.ref, a.alt, c.symbol, a.a_index""",
    # per-(variant, transcript) pathogenicity scores, as a missense plugin table
    "fx_plugin": """
SELECT a.contig, a.position, a.ref, a.alt, c.feature AS transcript, CAST((c.ord * 7 + a.vid) % 100 AS DOUBLE) / 100 AS am_score
FROM fx_alleles a JOIN fx_csq c ON a.vid = c.vid WHERE a.vid % 6 = 1""",
    # population labels: sample S<n> -> super population, S7 unlabelled
    "fx_pop_labels": """
SELECT concat('S', CAST(ln AS VARCHAR(8))) AS Sample,
       CASE ln WHEN 1 THEN 'AFR' WHEN 2 THEN 'EUR' WHEN 3 THEN 'CSA' WHEN 4 THEN 'EAS' WHEN 5 THEN 'AMR' WHEN 6 THEN 'OCE' END AS SuperPop
FROM (SELECT DISTINCT l_linenumber AS ln FROM lineitem) d""",
    # samples in VCF column order: ordinal 0 is the first sample column
    "fx_samples": """
SELECT DISTINCT concat('S', CAST(l_linenumber AS VARCHAR(8))) AS s, CAST(l_linenumber - 1 AS INT) AS ordinal FROM lineitem""",
    "fx_keep_samples": """
SELECT DISTINCT concat('S', CAST(l_linenumber AS VARCHAR(8))) AS s FROM lineitem WHERE l_linenumber IN (1, 3, 5)""",
}

ROWS_PER_FILE = 25_000

# dependency order for registration / CTE building
ORDER = list(FIXTURE_SQL)


def _deps(name: str) -> list[str]:
    toks = _tokens(FIXTURE_SQL[name])
    return [d for d in ORDER if d != name and d in toks]


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return [n for n in ORDER if n in seen]


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named fixtures and their deps."""
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in _closure(names)]
    return "WITH " + ",\n".join(parts) + "\n"


def _tokens(sql: str) -> set[str]:
    return set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())


# fixture -> (table, column) that it is dealt by once: the fixture's DISTINCT and its
# window then find each key's rows in one task, without a shuffle of their own
DEALT_BY = {"fx_csq": ("lineitem", "l_orderkey")}


def register_base(spark: SparkSession, sf_dir: str, tables=BASE_TABLES, dealt: tuple[str, str] | None = None) -> None:
    for t in tables:
        df = spark.read.parquet(os.path.join(sf_dir, f"{t}.parquet"))
        (df.repartition(dealt[1]) if dealt and dealt[0] == t else df).createOrReplaceTempView(t)


# (application, sf_dir, fixture) -> Parquet folder written in this session
_STORED: dict[tuple[str, str, str], str] = {}


def _derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture computed from the base tables (dependencies read from
    their stored copies)."""
    toks = _tokens(FIXTURE_SQL[name])
    register_base(spark, sf_dir, [t for t in BASE_TABLES if t in toks], DEALT_BY.get(name))
    for dep in _deps(name):
        fixture(spark, sf_dir, dep).createOrReplaceTempView(dep)
    return spark.sql(FIXTURE_SQL[name])


def fixture(spark: SparkSession, sf_dir: str, name: str, store: bool = True) -> DataFrame:
    """Fixture ``name`` over the driver tables of ``sf_dir``.

    With ``store`` (default) each fixture is derived once per session and
    written as Parquet into the shared checkpoint folder; later uses read
    that table, like any variant-shaped input table, instead of re-running
    the derivation inside every plan.
    """
    if not store:
        for n in _closure([name]):
            toks = _tokens(FIXTURE_SQL[n])
            register_base(spark, sf_dir, [t for t in BASE_TABLES if t in toks])
            spark.sql(FIXTURE_SQL[n]).createOrReplaceTempView(n)
        return spark.table(name)
    key = _key(spark, sf_dir, name)
    if key not in _STORED:
        _write_stored(spark, sf_dir, name, _prepare(spark, sf_dir, name))
    return read_stored(spark, _STORED[key])


_READS: dict[tuple[str, str], DataFrame] = {}


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table's DataFrame, listed once per session (plans are immutable)."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name)


def _prepare(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_stored(spark, _STORED[_key(spark, sf_dir, name)]) if _key(spark, sf_dir, name) in _STORED \
        else _derive(spark, sf_dir, name)


def _write_stored(spark: SparkSession, sf_dir: str, name: str, df: DataFrame) -> None:
    key = _key(spark, sf_dir, name)
    if key in _STORED:
        return
    from lociframe.session import ensure_checkpoint_dir
    digest = hashlib.sha1((key[1] + "\0" + FIXTURE_SQL[name]).encode()).hexdigest()[:16]
    path = os.path.join(ensure_checkpoint_dir(spark), "fixtures", f"{name}-{digest}")
    # several files, without a shuffle: small inputs would else read as one task
    df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path, compression="zstd")
    _STORED[key] = path


def store_all(spark: SparkSession, sf_dir: str, names=None, threads: int = 8) -> None:
    """Derive and store every fixture (or the named ones) up front, plus the
    shaped sites / calls tables and the fixture VCF.  Tables whose inputs
    are stored are written concurrently (independent Spark jobs from driver
    threads); plans are built on the calling thread."""
    from concurrent.futures import ThreadPoolExecutor

    todo = _closure(names or ORDER)
    done: set[str] = set()
    with ThreadPoolExecutor(max_workers=threads) as pool:
        while todo:
            ready = [n for n in todo if all(d in done for d in _deps(n))]
            # temp-view registration is session-global: derive the SQL of
            # this level on the driver thread, write in parallel
            frames = [(n, _prepare(spark, sf_dir, n)) for n in ready]
            list(pool.map(lambda nf: _write_stored(spark, sf_dir, *nf), frames))
            done.update(ready)
            todo = [n for n in todo if n not in done]
        if names is None:
            from lociframe.plans import inputs
            from lociframe.plans.queries import fixture_vcf_path
            list(pool.map(lambda f: f(), [lambda: inputs.sites(spark, sf_dir),
                                          lambda: inputs.sites(spark, sf_dir, with_csq=True)]))
            inputs.calls(spark, sf_dir)
            fixture_vcf_path(spark, sf_dir)
