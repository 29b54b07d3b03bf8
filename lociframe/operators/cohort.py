"""Cohort statistics over sites and long-form calls.

Per-variant statistics are one ``groupBy`` on the variant key over the calls
(map-side partial aggregation first, so at most one row per variant per task
crosses the shuffle) followed by a left join back to the sites.  A variant
holds at most one row per sample, so no group is unbounded by the data size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions.alleles import row_key


def info_fields(df: DataFrame) -> list[str]:
    return list(df.schema["info"].dataType.fieldNames()) if "info" in df.columns else []


def set_info(df: DataFrame, **fields) -> DataFrame:
    info = F.col("info")
    for name, value in fields.items():
        info = info.withField(name, value)
    return df.withColumn("info", info)


def add_cohort_ac_af(sites: DataFrame) -> DataFrame:
    """``cohort_AC = AC[a_index-1]``, ``cohort_AF = AF[a_index-1]``, each only
    if the INFO struct does not have it already."""
    have = set(info_fields(sites))
    new = {}
    i = F.col("a_index") - 1
    if "cohort_AC" not in have:
        new["cohort_AC"] = F.get(F.col("info.AC"), i)
    if "cohort_AF" not in have:
        new["cohort_AF"] = F.get(F.col("info.AF"), i)
    return set_info(sites, **new) if new else sites


def alt_allele_stats(calls: DataFrame, key=None) -> DataFrame:
    """Per variant: ``AN`` called alleles, ``AC1`` copies of allele 1, ``n_called``."""
    gt, key, more = F.col("GT"), key or row_key(calls), G.more_of(calls)
    return (calls.groupBy(*key).agg(
        F.sum(G.n_called_alleles(gt, more)).cast("int").alias("AN"),
        F.sum(G.n_copies(gt, lambda x: x == 1, more)).cast("int").alias("AC1"),
        F.count_if(G.is_called(gt)).cast("int").alias("n_called")))


def variant_qc(calls: DataFrame, key=None) -> DataFrame:
    """Allele counts per variant: ``AC`` array (one entry per allele), ``AN``,
    ``AF = AC/AN`` (NULL when nothing is called).

    Two aggregations: (variant, allele) counts, then the array per variant
    built from at most ``num_alleles`` rows; nothing collects samples.
    """
    gt, key = F.col("GT"), key or row_key(calls)
    alleles = (calls.where(G.is_called(gt))
               .select(*key, F.explode(G.alleles_of(gt, G.more_of(calls))).alias("_a")))
    per_allele = alleles.groupBy(*key, "_a").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    per_variant = (per_allele.groupBy(*key)
                   .agg(F.map_from_entries(F.collect_list(F.struct("_a", "_n"))).alias("_m"),
                        F.sum("_n").cast("int").alias("AN")))
    n_alleles = F.size("alleles") if "alleles" in key else F.lit(2)
    return per_variant.select(
        *key,
        F.transform(F.sequence(F.lit(0), n_alleles - 1), lambda i: F.coalesce(F.col("_m")[i], F.lit(0))).alias("AC"),
        "AN",
    ).withColumn("AF", F.transform("AC", lambda x: F.try_divide(x, F.col("AN"))))


def recompute_cohort_ac_af(sites: DataFrame, calls: DataFrame, key=None) -> DataFrame:
    """Cohort AC/AF of the split allele recomputed from the genotypes.

    Runs on split data (``a_index`` present): ``cohort_AC = AC[1]``,
    ``cohort_AF = AC[1]/AN``; a variant without calls gets AC 0, AF NULL.
    """
    key = key or row_key(sites, calls)
    st = alt_allele_stats(calls, key)
    out = sites.join(st, list(key), "left")
    return set_info(out,
                    cohort_AC=F.coalesce(F.col("AC1"), F.lit(0)),
                    cohort_AF=F.try_divide(F.col("AC1").cast("double"), F.col("AN"))).drop("AN", "AC1", "n_called")


def missing_counts(sites: DataFrame, fields: list[str]) -> DataFrame:
    """One row: ``n_missing_<field>`` for every INFO field, in one pass."""
    return sites.agg(*[F.count_if(F.col(f"info.`{f}`").isNull()).cast("long").alias(f"n_missing_{f}")
                       for f in fields])


def backfill_allele_specific(sites: DataFrame, count_on: DataFrame | None = None) -> DataFrame:
    """For every INFO field ``AS_<X>...`` whose target ``<X>`` exists: if the
    AS field is missing on fewer rows than the target, the whole target
    becomes ``AS[a_index-1]``.

    Fields are taken in the order of the struct, and a replaced target counts
    with its new values for the next field that names it.  One aggregate gives
    all counts that this can need (a single job): each field's missing rows,
    and for each AS field the rows where its own element is missing.
    ``count_on`` may name an upstream frame with the same rows and fields
    (e.g. before joins that do not touch them) so the count stays cheap.
    """
    fields = info_fields(sites)
    pairs = []
    for f in fields:
        if "AS_" in f:
            target = f.split("_")[1]
            if target in fields:
                pairs.append((f, target))
    if not pairs:
        return sites
    needed = sorted({x for p in pairs for x in p})
    base = count_on if count_on is not None else sites
    own = {a: F.get(F.col(f"info.`{a}`"), F.col("a_index") - 1) for a, _ in pairs}
    counts = base.agg(*[F.count_if(F.col(f"info.`{f}`").isNull()).alias(f"n_{f}") for f in needed],
                      *[F.count_if(own[a].isNull()).alias(f"own_{a}") for a, _ in pairs]).first().asDict()
    missing = {f: counts[f"n_{f}"] for f in needed}
    new = {}
    for as_field, target in pairs:
        if missing[as_field] < missing[target]:
            new[target] = own[as_field]
            missing[target] = counts[f"own_{as_field}"]
    return set_info(sites, **new) if new else sites


def info_depth(sites: DataFrame, calls: DataFrame, key=None) -> DataFrame:
    """INFO DP = sum over samples of sum(AD); 0 when no sample has AD."""
    key = key or row_key(sites, calls)
    dp = calls.groupBy(*key).agg(F.sum(G.array_sum_skip_null(F.col("AD"))).alias("_dp"))
    out = sites.join(dp, list(key), "left")
    return set_info(out, DP=F.coalesce(F.col("_dp"), F.lit(0)).cast("int")).drop("_dp")
