"""Row / sample filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions.alleles import row_key
from lociframe.operators import cohort as CO
from lociframe.operators.genotypes import haploid_to_diploid


def keep_samples(calls: DataFrame, samples: DataFrame, col: str = "s") -> DataFrame:
    """Calls of the listed samples only (semi join on the sample id; Spark
    sends the list to the calls if its size allows)."""
    return calls.join(samples.select(F.col(samples.columns[0]).alias(col)), col, "left_semi")


def subset_samples(sites: DataFrame, calls: DataFrame, samples: DataFrame, key=None):
    """Keep listed samples, recompute allele counts, keep variants whose first
    alternate allele is still carried (``AC[1] > 0``).  Returns (sites, calls)."""
    key = key or row_key(sites, calls)
    kept = haploid_to_diploid(keep_samples(calls, samples))
    st = CO.alt_allele_stats(kept, key).where(F.col("AC1") > 0).select(*key, "AC1")
    new_sites = sites.join(st, list(key), "inner")
    new_calls = kept.join(st.select(*key), list(key), "left_semi")
    return new_sites, new_calls


def drop_first_sample(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Drop the sample in the first genotype column (``ordinal = 0``)."""
    rest = samples.where(F.col("ordinal") > 0).select("s")
    return calls.join(rest, "s", "left_semi")


def keep_contig(df: DataFrame, contig: str) -> DataFrame:
    return df.where(F.col("contig") == contig)


def clean_population_labels(labels: DataFrame, col: str = "SuperPop") -> DataFrame:
    """``CSA`` -> ``SAS``, then ``EUR`` -> ``NFE`` (substring replacements, in
    that order), then drop ``OCE``; a missing label is dropped as well."""
    v = F.replace(F.replace(F.col(col), F.lit("CSA"), F.lit("SAS")), F.lit("EUR"), F.lit("NFE"))
    return labels.withColumn(col, v).where(F.col(col) != "OCE")
