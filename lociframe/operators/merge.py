"""Combining call sets: genotypes back onto annotated sites, cohort unions,
sample merges across files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.functions.alleles import VARIANT_KEY, row_key
from lociframe.operators.genotypes import haploid_to_diploid
from lociframe.operators.split import split_calls


def version_sorted(paths):
    """File list in version order of base names (digit runs compared as
    numbers: ``shard_2`` before ``shard_10``); a list of paths, not data."""
    import os
    import re

    def key(p):
        return [(0, int(t)) if t.isdigit() else (1, t) for t in re.split(r"(\d+)", os.path.basename(p)) if t]
    return sorted(paths, key=key)


def add_genotypes(annotated_sites: DataFrame, calls: DataFrame, key=None) -> DataFrame:
    """Put genotypes back: split the original calls the same way as the
    sites were split, then inner-join on what identifies a row of both (the
    record and allele where the tables carry them).  Site fields win over
    same-named call fields."""
    c = haploid_to_diploid(split_calls(calls))
    key = key or row_key(annotated_sites, c)
    site_cols = set(annotated_sites.columns)
    c = c.select(*key, *[x for x in c.columns if x not in site_cols])
    return annotated_sites.join(c, list(key), "inner")


def union_tables(tables, allow_missing_columns: bool = True) -> DataFrame:
    """Row union by column *name*; a column missing in a table reads NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing_columns), tables)


def union_by_position(tables) -> DataFrame:
    """Row union by column *position*; names come from the first table."""
    first = tables[0]
    return reduce(lambda a, b: a.union(b.toDF(*first.columns)), tables[1:], first)


def concat_records(tables, allow_overlaps: bool = False, build: str = "GRCh38") -> DataFrame:
    """Concatenate record sets.  Naive: file order, duplicates kept
    (``file_idx`` tells the source).  Allow-overlaps: merged into coordinate
    order with a global rank ``rn``."""
    from lociframe.operators.sharding import coordinate_sort
    tagged = [t.withColumn("file_idx", F.lit(i + 1)) for i, t in enumerate(tables)]
    out = union_tables(tagged)
    return coordinate_sort(out, build) if allow_overlaps else out


#: rows of repeated records that a merge broadcasts at most
FEW = 200_000


def _ids(*tables) -> list[str]:
    """The columns that name a source record, or an allele split from it, in all tables."""
    return [c for c in ("file_idx", "file_id", "record", "a_index") if all(c in t.columns for t in tables)]


def number_records(sites: DataFrame, calls: DataFrame, key) -> tuple[DataFrame, DataFrame]:
    """``occurrence`` on both tables: the how-maniest record of its key (and file)
    a row belongs to, in file order.  Records that repeat a key are few: only
    those are looked up from the calls, by a broadcast where they are at most
    ``FEW``, and every other call is of a first record; so the calls stay where
    they are."""
    ids = _ids(sites, calls)
    per_file = [c for c in ids if c == "file_idx"]
    nth = Window.partitionBy(*per_file, *key).orderBy(*[c for c in ids if c != "file_idx"])
    sites = sites.withColumn("occurrence", F.row_number().over(nth))
    repeated = sites.where(F.col("occurrence") > 1).select(*[F.col(c).alias(f"_{c}") for c in ids], F.col("occurrence").alias("_nth"))
    if repeated.limit(FEW + 1).count() <= FEW:
        repeated = F.broadcast(repeated)
    same = reduce(lambda x, y: x & y, [calls[c] == F.col(f"_{c}") for c in ids])
    calls = (calls.join(repeated, same, "left").withColumn("occurrence", F.coalesce("_nth", F.lit(1)))
             .drop("_nth", *[f"_{c}" for c in ids]))
    return sites, calls


def union_cohorts(sites_a: DataFrame, calls_a: DataFrame, sites_b: DataFrame, calls_b: DataFrame,
                  key=VARIANT_KEY, exclude=("PGT",)):
    """Samples of two cohorts side by side on the variants both have.

    Rows: inner join of the two site tables on the variant key (fields of
    the first cohort kept); where the tables carry a ``record``, the n-th record
    of a key meets the n-th of the other cohort (``occurrence``), and those beyond
    are in one cohort only and fall out.  Entries: the fields common to both
    call tables minus ``PGT``, unioned.  Returns (sites, calls).
    """
    from lociframe.operators.genotypes import common_entry_fields
    key = list(key)
    own = [c for c in ("file_id", "record") if c in calls_a.columns or c in calls_b.columns]
    fields = common_entry_fields(calls_a, calls_b, (*exclude, *own))
    if "record" in _ids(sites_a, calls_a) and "record" in _ids(sites_b, calls_b):
        sites_a, calls_a = number_records(sites_a, calls_a, key)
        sites_b, calls_b = number_records(sites_b, calls_b, key)
        key = ["occurrence", *key]
    shared = sites_b.select(*key)
    sites = sites_a.join(shared, list(key), "left_semi")
    ca = calls_a.join(shared, list(key), "left_semi").select(*key, "s", *fields)
    cb = calls_b.join(sites_a.select(*key), list(key), "left_semi").select(*key, "s", *fields)
    return sites.drop(*own), ca.unionByName(cb, allowMissingColumns=True)


def merge_sample_sets(files, key=VARIANT_KEY):
    """Merge the samples of several call sets (``[(sites, calls, samples), ...]``
    in file order): records are matched on the full variant key (records with
    different alleles stay separate), a sample name already used by an
    earlier file becomes ``"<file number>:<name>"``, and a sample without a
    call at a record simply has no row (missing).  Where the tables carry a
    ``record``, records of one file that share a key stay separate: the n-th of a
    file meets the n-th of the others (``occurrence``).  A call whose sample is not
    in its file's sample table keeps its name.  Returns (sites, calls, samples).
    """
    tagged_samples = union_tables([smp.select("s", "ordinal").withColumn("file_idx", F.lit(i + 1))
                                   for i, (_, _, smp) in enumerate(files)])
    first_file = tagged_samples.groupBy("s").agg(F.min("file_idx").alias("_first"))
    renamed = (tagged_samples.join(first_file, "s")
               .withColumn("new_s", F.when(F.col("file_idx") > F.col("_first"),
                                           F.concat(F.col("file_idx").cast("string"), F.lit(":"), F.col("s")))
                           .otherwise(F.col("s")))
               .drop("_first"))
    calls = union_tables([c.withColumn("file_idx", F.lit(i + 1)) for i, (_, c, _) in enumerate(files)])
    calls = (calls.join(renamed.select("file_idx", "s", "new_s"), ["file_idx", "s"], "left")
             .withColumn("s", F.coalesce("new_s", "s")).drop("new_s"))
    sites = union_tables([st.withColumn("file_idx", F.lit(i + 1)) for i, (st, _, _) in enumerate(files)])
    key = list(key)
    if "record" in _ids(sites, calls):
        sites, calls = number_records(sites, calls, key)
        sites, calls, key = sites.drop("file_id", "record"), calls.drop("file_id", "record"), ["occurrence", *key]
    # one record per key; the earliest file's fields win
    others = [c for c in sites.columns if c not in key]
    sites = (sites.groupBy(*key).agg(F.min_by(F.struct(*others), F.col("file_idx")).alias("_r"))
             .select(*key, "_r.*").drop("file_idx"))
    samples = renamed.select(F.col("new_s").alias("s"), "file_idx", "ordinal")
    return sites, calls.drop("file_idx"), samples
