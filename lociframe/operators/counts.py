"""Record counts on raw VCF records (one aggregate pass each)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions.alleles import is_indel_text, is_snv_text


def alt_text(alleles: Column) -> Column:
    """The ALT column as written: alternates comma-joined, ``.`` when none."""
    alts = F.slice(alleles, 2, F.size(alleles) - 1)
    return F.when(F.size(alts) > 0, F.array_join(alts, ",", ".")).otherwise(F.lit("."))


def variant_type_counts(records: DataFrame, by: str | None = None) -> DataFrame:
    """``n_records``, ``n_snv`` (1-base REF and 1-character ALT field) and
    ``n_indel`` (REF and ALT field of different length), per ``by`` or total.

    Shards are summed exactly (every count, not the first number of a line).
    """
    ref, alt = F.col("alleles")[0], alt_text(F.col("alleles"))
    aggs = [F.count(F.lit(1)).alias("n_records"),
            F.count_if(is_snv_text(ref, alt)).alias("n_snv"),
            F.count_if(is_indel_text(ref, alt)).alias("n_indel")]
    return records.groupBy(by).agg(*aggs) if by else records.agg(*aggs)


def total_of_shards(per_shard: DataFrame) -> DataFrame:
    """Sum per-shard counts into one row."""
    return per_shard.agg(*[F.sum(c).cast("long").alias(c) for c in ("n_records", "n_snv", "n_indel")])


def records_per_contig(records: DataFrame) -> DataFrame:
    return records.groupBy("contig").agg(F.count(F.lit(1)).alias("n_records"))


def sample_count(samples: DataFrame) -> DataFrame:
    return samples.agg(F.countDistinct("s").alias("n_samples"))
