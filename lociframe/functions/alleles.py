"""Column expressions over loci and alleles (no UDFs: all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANT_KEY = ["contig", "position", "alleles"]
#: columns that tell records apart that share a variant key: the source file and
#: the record in it, the allele a split row came from, the how-maniest of its key
#: in a merge
RECORD_COLUMNS = ["file_id", "record", "a_index", "occurrence"]


def row_key(*frames) -> list[str]:
    """What identifies a row in all ``frames``: the variant key, with the record
    columns that all of them carry.  (Score tables have the variant key only.)"""
    return [c for c in RECORD_COLUMNS if all(c in f.columns for f in frames)] + VARIANT_KEY

# Contig names of the two genome builds, in sort order.
GRCH37_CONTIGS = [str(i) for i in range(1, 23)] + ["X", "Y"]
GRCH38_CONTIGS = [f"chr{c}" for c in GRCH37_CONTIGS]


def build_contigs(build: str) -> list[str]:
    if build == "GRCh38":
        return list(GRCH38_CONTIGS)
    if build == "GRCh37":
        return list(GRCH37_CONTIGS)
    raise ValueError(f"unknown genome build {build!r}")


def contig_order(build: str) -> Column:
    """Ordinal of ``contig`` within the build (NULL for contigs outside it).

    A literal map keeps the lookup inside codegen; it has 24 entries.
    """
    pairs = []
    for i, c in enumerate(build_contigs(build)):
        pairs += [F.lit(c), F.lit(i)]
    return F.create_map(*pairs)[F.col("contig")]


def _common_len(m: Column, same) -> Column:
    """Largest n <= m such that the first n characters agree, by halving steps:
    ``same(n, k)`` compares the next k after n agreeing ones.  The steps grow
    with the logarithm of the length, so long alleles cost little."""
    steps = F.sequence(F.floor(F.log2(F.greatest(m, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1))
    width = F.transform(steps, lambda e: F.pow(F.lit(2), e).cast("int"))
    return F.aggregate(width, F.lit(0), lambda n, k: F.when((n + k <= m) & same(n, k), n + k).otherwise(n))


def common_suffix_len(a: Column, b: Column) -> Column:
    """Length of the common suffix of ``a`` and ``b`` that leaves each at
    least one character."""
    m = F.least(F.length(a), F.length(b)) - 1
    return _common_len(m, lambda n, k: F.substr(a, -(n + k), k) == F.substr(b, -(n + k), k))


def common_prefix_len(a: Column, b: Column) -> Column:
    """Length of the common prefix of ``a`` and ``b`` that leaves each at
    least one character."""
    m = F.least(F.length(a), F.length(b)) - 1
    return _common_len(m, lambda n, k: F.substr(a, n + 1, k) == F.substr(b, n + 1, k))


def with_min_rep(df, position: str, ref: str, alt: str, when: Column | None = None,
                 prefix: str = "_mr") -> "DataFrame":
    """Minimal representation of the pair ``(ref, alt)`` at ``position``.

    Trim the common suffix first, then the common prefix, always keeping at
    least one base of each allele; the position moves by the prefix length.
    Adds ``{prefix}_pos``, ``{prefix}_ref``, ``{prefix}_alt``.  Each step is
    its own column so every higher-order function runs once per row, and
    only where ``when`` holds (other rows keep their values).
    """
    cond = F.lit(True) if when is None else when
    suf, r1, a1, pre = (f"{prefix}_{x}" for x in ("suf", "r1", "a1", "pre"))
    df = df.withColumn(suf, F.when(cond, common_suffix_len(F.col(ref), F.col(alt))).otherwise(F.lit(0)))
    df = df.withColumns({r1: F.left(F.col(ref), F.length(ref) - F.col(suf)),
                         a1: F.left(F.col(alt), F.length(alt) - F.col(suf))})
    df = df.withColumn(pre, F.when(cond, common_prefix_len(F.col(r1), F.col(a1))).otherwise(F.lit(0)))
    return df.withColumns({f"{prefix}_pos": F.col(position) + F.col(pre),
                           f"{prefix}_ref": F.substr(F.col(r1), F.col(pre) + 1),
                           f"{prefix}_alt": F.substr(F.col(a1), F.col(pre) + 1)}).drop(suf, r1, a1, pre)


def is_snv_text(ref: Column, alt_text: Column) -> Column:
    """SNV test on raw record text: one-base REF and one-character ALT field."""
    return (F.length(ref) == 1) & (F.length(alt_text) == 1)


def is_indel_text(ref: Column, alt_text: Column) -> Column:
    """Indel test on raw record text: REF and whole ALT field differ in length."""
    return F.length(ref) != F.length(alt_text)
