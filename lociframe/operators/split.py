"""Split multi-allelic records into bi-allelic rows (sites and calls).

Both functions are *narrow*: one input row yields its output rows in the same
task (``posexplode``), so splitting never shuffles.  The calls table carries
the variant key (including ``alleles``), which is what lets the calls side be
split without joining back to the sites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions.alleles import with_min_rep


def _explode_alts(df: DataFrame) -> DataFrame:
    """One row per ALT with ``a_index`` (1-based) and the record-level flags.

    Records with a single allele (ALT ``.``) have nothing to split and drop
    out, as both branches of the split require at least two alleles.
    """
    n = F.size("alleles")
    out = (df.filter(n >= 2)
           .withColumn("num_alleles", n)
           .select("*", F.posexplode(F.slice("alleles", 2, F.size("alleles") - 1)).alias("_pos", "_alt"))
           .withColumns({"a_index": (F.col("_pos") + 1).cast("int"),
                         "was_split": F.col("num_alleles") > 2,
                         "_ref": F.col("alleles")[0]})
           # star alleles only disappear when a record is really split
           .filter(~(F.col("was_split") & (F.col("_alt") == "*"))))
    out = with_min_rep(out, "position", "_ref", "_alt", when=F.col("was_split"))
    return (out.withColumns({"position": F.col("_mr_pos"),
                             "alleles": F.array(F.col("_mr_ref"), F.col("_mr_alt"))})
            .drop("_pos", "_alt", "_ref", "_mr_pos", "_mr_ref", "_mr_alt"))


def split_multi(sites: DataFrame) -> DataFrame:
    """Split sites: adds ``num_alleles``, ``a_index``, ``was_split``.

    Bi-allelic records pass unchanged (``a_index=1, was_split=false``);
    multi-allelic ones give one minimally represented row per non-star ALT.
    A table that already has ``num_alleles`` was split before and is
    returned as is.
    """
    if "num_alleles" in sites.columns:
        if "a_index" not in sites.columns:
            raise ValueError("table has num_alleles but no a_index: cannot tell how it was split")
        return sites
    return _explode_alts(sites)


def split_calls(calls: DataFrame) -> DataFrame:
    """Split long-form calls along with their variant.

    GT is downcoded against ``a_index``; AD becomes ``[sum-own, own]``; PL
    (if the table has one) becomes the minimum per number of copies.
    """
    if "num_alleles" in calls.columns:
        return calls
    out = _explode_alts(calls)
    a = F.col("a_index")
    if "GT" in out.columns:
        out = out.withColumn("GT", G.downcode(F.col("GT"), a, G.more_of(out)))
    if "AD" in out.columns:
        out = out.withColumn("AD", G.split_ad(F.col("AD"), a))
    if "PL" in out.columns:
        out = G.with_split_pl(out, "PL", "a_index", "num_alleles")
    return out
