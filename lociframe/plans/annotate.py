"""Consequence annotation of a call set (sites first, genotypes later).

split multi-allelics -> cohort AC/AF of the split allele -> [recompute them
from genotypes] -> allele-specific backfill -> consequences, either joined
from a precomputed table keyed by variant or produced by a user function
through the annotator hook.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions.alleles import VARIANT_KEY
from lociframe.operators import cohort as CO
from lociframe.operators.lookup import lookup
from lociframe.operators.split import split_calls, split_multi


def annotate_with(sites: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], out: str = "CSQ",
                  out_type: str = "array<string>", key=VARIANT_KEY) -> DataFrame:
    """Annotator hook: ``fn`` gets a pandas batch of ``contig, position, ref,
    alt`` and returns one value per row; a batch that fails is halved, and each
    half tried anew, down to the rows that fail alone: they get NULL (parse errors
    are tolerated).  So b bad rows of n cost about 2 b log n calls.

    Runs per partition with Arrow batches (``mapInPandas``); only the key
    columns travel to Python, the result is joined back on the key.
    """
    keys = sites.select(*key).dropDuplicates(list(key))
    flat = keys.select("contig", "position", F.col("alleles")[0].alias("ref"),
                       F.array_join(F.slice("alleles", 2, F.size("alleles") - 1), ",").alias("alt"), "alleles")
    schema = f"contig string, position long, alleles array<string>, {out} {out_type}"

    def tolerant(inp):
        try:
            return list(fn(inp))
        except Exception:
            if len(inp) < 2:
                return [None] * len(inp)
        half = len(inp) // 2
        return tolerant(inp.iloc[:half]) + tolerant(inp.iloc[half:])

    def run(batches):
        for pdf in batches:
            vals = tolerant(pdf[["contig", "position", "ref", "alt"]])
            yield pd.DataFrame({"contig": pdf["contig"], "position": pdf["position"],
                                "alleles": pdf["alleles"], out: vals})

    ann = flat.mapInPandas(run, schema)
    res = sites.join(ann, list(key), "left")
    return res.withColumn("info", F.col("info").withField(out, F.col(out))).drop(out)


def annotate_from_table(sites: DataFrame, consequences: DataFrame, out: str = "CSQ", col: str = "CSQ") -> DataFrame:
    """Consequences from a precomputed table keyed by variant (one row kept per key)."""
    res = lookup(sites, consequences, {k: F.col(k) for k in VARIANT_KEY}, {out: col})
    return res.withColumn("info", F.col("info").withField(out, F.col(out))).drop(out)


def annotate_sites(sites: DataFrame, calls: DataFrame | None = None, reannotate_ac_af: bool = False,
                   consequences: DataFrame | None = None, annotator=None, keep_earlier: bool = False) -> DataFrame:
    """The chain on sites.  ``keep_earlier`` keeps an annotation that is already
    there as ``info.CSQ_earlier`` before the new one replaces it."""
    if reannotate_ac_af and calls is None:
        raise ValueError("reannotate_ac_af needs the calls")
    split = CO.add_cohort_ac_af(split_multi(sites))
    if keep_earlier and "CSQ" in CO.info_fields(split):
        split = CO.set_info(split, CSQ_earlier=F.col("info.CSQ"))
    s = split
    if reannotate_ac_af:
        s = CO.recompute_cohort_ac_af(s, split_calls(calls))
    # the recount touches only cohort_AC/AF: the backfill decision is taken
    # on the split sites, without re-running the genotype aggregation
    s = CO.backfill_allele_specific(s, count_on=split)
    if consequences is not None:
        s = annotate_from_table(s, consequences)
    elif annotator is not None:
        s = annotate_with(s, annotator)
    return s


def add_hgvsc_symbol(sites: DataFrame, csq_description: str, key=VARIANT_KEY, col: str = "CSQ"):
    """Append ``HGVSc_symbol`` (SYMBOL and the parts after ``:`` of non-empty
    HGVSc / HGVSp, ``", "``-joined) to every packed entry: one explode /
    regroup cycle.  Returns ``(sites, new_description)``."""
    from lociframe.operators import packed as PK
    fields = PK.fields_from_description(csq_description)
    e = PK.explode_packed(sites, F.col(f"info.{col}"), fields, key)
    e = e.withColumn("t_HGVSc_symbol", PK.hgvsc_symbol(F.col("t_SYMBOL"), F.col("t_HGVSc"), F.col("t_HGVSp")))
    packed = PK.regroup(e, fields + ["HGVSc_symbol"], key=key, as_array=True, out="_csq")
    out = sites.join(packed, list(key), "left")
    out = out.withColumn("info", F.col("info").withField(col, F.col("_csq"))).drop("_csq")
    return out, PK.extend_description(csq_description, ["HGVSc_symbol"])
