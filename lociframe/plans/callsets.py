"""End-to-end plans for the smaller call-set tasks: depth and likelihood
re-estimation, variant counts per shard, merging call sets, stored call set
to VCF, and ancestry inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociframe.operators import ancestry as AN
from lociframe.operators import cohort as CO
from lociframe.operators import counts as CT
from lociframe.operators import filters as FL
from lociframe.operators import genotypes as GT
from lociframe.operators import header as HD
from lociframe.operators import merge as MG
from lociframe.operators.sharding import coordinate_sort
from lociframe.sinks import vcf as KV
from lociframe.sources.vcf import Vcf, VcfHeader


# Header descriptions of the re-estimated fields.
FORMAT_DP_DESCRIPTION = "Approximate read depth, estimated as sum of AD per sample."
INFO_DP_DESCRIPTION = "Approximate read depth, estimated as sum of AD across samples."
PL_DESCRIPTION = ("Normalized, Phred-scaled likelihoods for genotypes as defined in the VCF specification "
                  "(estimated using GQ).")


def add_depth(v: Vcf, with_pl: bool = False) -> Vcf:
    """FORMAT DP = sum(AD) per call, INFO DP = its sum over samples (0 when
    none), haploid calls made diploid; with ``with_pl`` also PL estimated from
    GQ and AD.  Existing DP / PL are replaced; header entries declared."""
    calls = GT.haploid_to_diploid(v.calls).drop("DP", "PL")
    calls = GT.format_depth(calls)
    sites = v.sites
    if "info" in sites.columns and "DP" in CO.info_fields(sites):
        sites = sites.withColumn("info", F.col("info").dropFields("DP"))
    sites = CO.info_depth(sites, calls)
    h = HD.set_field(v.header, "FORMAT", "DP", "1", "Integer", FORMAT_DP_DESCRIPTION)
    h = HD.set_field(h, "INFO", "DP", "1", "Integer", INFO_DP_DESCRIPTION)
    if with_pl:
        calls = GT.estimate_pl(calls)
        h = HD.set_field(h, "FORMAT", "PL", "G", "Integer", PL_DESCRIPTION)
    return Vcf(h, sites, calls, v.samples)


def count_variants(shards: DataFrame, shard_col: str) -> tuple[DataFrame, DataFrame]:
    """Per-shard SNV / indel / record counts and their total."""
    per = CT.variant_type_counts(shards, by=shard_col)
    return per, CT.total_of_shards(per)


def merge_callsets(files: list[Vcf], keep_format=("GT", "AD", "DP", "GQ", "PL"), sort: bool = False,
                   build: str = "GRCh38") -> Vcf:
    """Merge the samples of several call sets (records matched on the full
    variant key, repeated sample names renamed), keep the listed FORMAT
    fields, declare the merge FILTERs; optionally rank in coordinate order."""
    parts = [(f.sites, GT.keep_format_fields(f.calls, keep_format), f.samples) for f in files]
    sites, calls, samples = MG.merge_sample_sets(parts)
    # genotype columns of file k follow those of files < k: offset by the
    # sample counts of earlier files (a table with one row per file)
    per_file = samples.groupBy("file_idx").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("file_idx").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("file_idx", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    samples = (samples.join(F.broadcast(offsets), "file_idx")
               .withColumn("ordinal", (F.col("_off") + F.col("ordinal")).cast("int")).drop("_off"))
    if sort:
        sites = coordinate_sort(sites, build)
    header = HD.add_merge_filters(files[0].header)
    return Vcf(header, sites, calls, samples.select("s", "ordinal"))


def callset_to_vcf(spark: SparkSession, header: VcfHeader, sites: DataFrame, calls: DataFrame | None,
                   samples: DataFrame | None, path: str, build: str = "GRCh38") -> None:
    """Stored call set -> coordinate-sorted VCF parts."""
    KV.write_vcf(spark, header, sites, path, calls=calls, samples=samples, build=build)


def infer_ancestry(cohort_sites: DataFrame, cohort_calls: DataFrame, panel_sites: DataFrame,
                   panel_calls: DataFrame, loadings: DataFrame, labels: DataFrame, num_pcs: int = 16,
                   min_prob: float = 0.75, model=None) -> DataFrame:
    """Ancestry of cohort samples: high-quality cohort genotypes + labelled
    panel samples on the shared variants, projected on the loadings, then a
    classifier trained on the panel (or a saved ``model``).  Output per
    sample: ``s, scores, known_pop, pop, prob_<pop>...``."""
    labels = FL.clean_population_labels(labels)
    panel_calls = FL.keep_samples(panel_calls, labels.select("Sample"))
    cohort_calls = GT.filter_to_adj(cohort_calls if "DP" in cohort_calls.columns else GT.format_depth(cohort_calls))
    _, calls = MG.union_cohorts(cohort_sites, cohort_calls, panel_sites, panel_calls)
    scores = AN.pc_project(calls, loadings)
    scores = AN.attach_known_population(scores, labels).where(F.col("scores").isNotNull())
    if model is not None:
        return AN.apply_population_model(scores, model, min_prob=min_prob, num_pcs=num_pcs)
    return AN.assign_population(scores, num_pcs=num_pcs, min_prob=min_prob)


def write_ancestry_tsv(assigned: DataFrame, path: str) -> None:
    """The per-sample ancestry table as TSV (scores written as ``[a, b, ...]``)."""
    from lociframe.sinks.tables import write_tsv
    out = assigned.withColumn("pca_scores", F.concat(F.lit("["), F.array_join(
        F.transform("pca_scores", lambda x: x.cast("string")), ", "), F.lit("]")))
    write_tsv(out, path)
