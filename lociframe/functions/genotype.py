"""Genotype (call) expressions.

A call is ``GT struct<a1:int, a2:int, phased:boolean[, more:array<int>]>``: the
allele indices; ``a2 IS NULL`` marks a haploid call, ``a1 IS NULL`` a missing
call, and ``more`` holds the alleles after the second of a call of three and
more (NULL for others).  Tables without ``more`` hold up to two alleles a call,
and their expressions stay as short as that allows: functions take ``more`` as
an argument, which ``more_of`` finds for a table.  Array entries (AD, PL) may
hold NULL elements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GT_TYPE = T.StructType([
    T.StructField("a1", T.IntegerType()),
    T.StructField("a2", T.IntegerType()),
    T.StructField("phased", T.BooleanType()),
])


def call(a1: Column, a2: Column, phased: Column | bool = False, more: Column | None = None) -> Column:
    """Build a GT struct; NULL when the first allele is missing."""
    ph = phased if isinstance(phased, Column) else F.lit(phased)
    extra = [] if more is None else [more.cast("array<int>").alias("more")]
    return F.when(a1.isNotNull(), F.struct(a1.cast("int").alias("a1"), a2.cast("int").alias("a2"),
                                           ph.alias("phased"), *extra))


def more_of(calls: DataFrame, gt: str = "GT") -> Column | None:
    """The alleles after the second of each call, None for a table without them."""
    fields = calls.schema[gt].dataType.fieldNames() if gt in calls.columns else []
    return F.col(gt)["more"] if "more" in fields else None


def alleles_of(gt: Column, more: Column | None = None) -> Column:
    """All alleles of a call as an array."""
    two = F.array_compact(F.array(gt["a1"], gt["a2"]))
    return two if more is None else F.when(more.isNull(), two).otherwise(F.concat(two, more))


def is_called(gt: Column) -> Column:
    return gt.isNotNull() & gt["a1"].isNotNull()


def is_haploid(gt: Column) -> Column:
    return is_called(gt) & gt["a2"].isNull()


def _all_more(more: Column | None, test) -> Column:
    return F.lit(True) if more is None else F.coalesce(F.forall(more, test), F.lit(True))


def is_hom_ref(gt: Column, more: Column | None = None) -> Column:
    return is_called(gt) & (gt["a1"] == 0) & F.coalesce(gt["a2"] == 0, F.lit(True)) & _all_more(more, lambda x: x == 0)


def is_het(gt: Column, more: Column | None = None) -> Column:
    return is_called(gt) & gt["a2"].isNotNull() & ~((gt["a1"] == gt["a2"]) & _all_more(more, lambda x: x == gt["a1"]))


def is_hom_var(gt: Column, more: Column | None = None) -> Column:
    return (is_called(gt) & (gt["a1"] > 0) & F.coalesce(gt["a2"] == gt["a1"], F.lit(True))
            & _all_more(more, lambda x: x == gt["a1"]))


def _count_more(more: Column | None, test) -> Column:
    return F.lit(0) if more is None else F.coalesce(F.size(F.filter(more, test)), F.lit(0))


def n_copies(gt: Column, test, more: Column | None = None) -> Column:
    """Number of alleles for which ``test`` holds (0 for a missing call)."""
    two = F.coalesce(test(gt["a1"]).cast("int"), F.lit(0)) + F.coalesce(test(gt["a2"]).cast("int"), F.lit(0))
    return F.when(is_called(gt), two + _count_more(more, test)).otherwise(F.lit(0))


def n_alt_alleles(gt: Column, more: Column | None = None) -> Column:
    """Number of non-reference alleles (NULL for a missing call)."""
    return F.when(is_called(gt), n_copies(gt, lambda x: x > 0, more))


def n_called_alleles(gt: Column, more: Column | None = None) -> Column:
    extra = F.lit(0) if more is None else F.coalesce(F.size(more), F.lit(0))
    return F.when(is_called(gt), F.lit(1) + gt["a2"].isNotNull().cast("int") + extra).otherwise(F.lit(0))


def haploid_to_diploid(gt: Column) -> Column:
    """Haploid call ``a`` becomes the homozygous diploid ``a/a``."""
    return F.when(is_haploid(gt), gt.withField("a2", gt["a1"])).otherwise(gt)


def downcode(gt: Column, a_index: Column, more: Column | None = None) -> Column:
    """Every allele equal to ``a_index`` becomes 1, every other allele 0.

    Unphased calls come out sorted (``1/0`` -> ``0/1``, ``2/1/2`` -> ``0/1/1``);
    phased calls keep their order; haploid calls stay haploid.
    """
    d1 = (gt["a1"] == a_index).cast("int")
    d2 = (gt["a2"] == a_index).cast("int")
    unphased_sort = gt["a2"].isNotNull() & ~F.coalesce(gt["phased"], F.lit(False))
    lo = F.when(unphased_sort, F.least(d1, d2)).otherwise(d1)
    hi = F.when(unphased_sort, F.greatest(d1, d2)).otherwise(d2)
    two = F.struct(lo.alias("a1"), hi.alias("a2"), gt["phased"].alias("phased"))
    if more is None:
        return F.when(is_called(gt), two)
    coded = F.transform(alleles_of(gt, more), lambda x: (x == a_index).cast("int"))
    coded = F.when(unphased_sort, F.array_sort(coded)).otherwise(coded)
    many = F.struct(F.get(coded, 0).alias("a1"), F.get(coded, 1).alias("a2"), gt["phased"].alias("phased"),
                    F.slice(coded, 3, F.size(coded) - 2).alias("more"))
    two = two.withField("more", F.lit(None).cast("array<int>"))
    return F.when(is_called(gt), F.when(more.isNull(), two).otherwise(many))


def array_sum_skip_null(arr: Column) -> Column:
    """Sum of the defined elements; NULL array -> NULL."""
    return F.when(arr.isNotNull(), F.aggregate(arr, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0))))


def split_ad(ad: Column, a_index: Column) -> Column:
    """AD of a split allele: ``[sum(AD) - AD[i], AD[i]]``; missing stays missing."""
    own = F.get(ad, a_index)
    return F.when(ad.isNotNull(), F.array(array_sum_skip_null(ad) - own, own))


def gt_index(j: Column, k: Column) -> Column:
    """PL position of the unphased genotype ``j/k``."""
    lo, hi = F.least(j, k), F.greatest(j, k)
    return (hi * (hi + 1) / 2).cast("int") + lo


def n_genotypes(n: Column, ploidy: Column) -> Column:
    """Number of unphased genotypes of ``ploidy`` alleles out of ``n``: the
    multisets, C(n + ploidy - 1, ploidy)."""
    return F.aggregate(F.sequence(F.lit(1), ploidy), F.lit(1).cast("long"), lambda c, i: (c * (n - 1 + i) / i).cast("long"))


def ploidy_of(size: Column, n: Column) -> Column:
    """The ploidy that has ``size`` unphased genotypes out of ``n`` alleles (two
    at least); NULL if none has.

    Each further allele of a genotype adds ``n - 1`` genotypes or more, so there are
    few ploidies to try; each number of genotypes comes from the one before, and
    none is computed beyond ``size``."""
    def tried(acc, p):
        count = (acc["count"] * (n - 1 + p) / p).cast("long")
        return F.when(acc["count"] < size, F.struct(count.alias("count"), p.alias("ploidy"))).otherwise(acc)

    last = F.greatest(((size - 1) / (n - 1)).cast("int"), F.lit(1))
    start = F.struct(F.lit(1).cast("long").alias("count"), F.lit(0).alias("ploidy"))
    return F.aggregate(F.sequence(F.lit(1), last), start, tried,
                       lambda acc: F.when((acc["count"] == size) & (acc["ploidy"] > 0), acc["ploidy"]))


def copies_by_genotype(n: Column, ploidy: Column, a: Column) -> Column:
    """For every genotype index of a ploidy how often allele ``a`` occurs in it.

    A sorted genotype of p alleles has the index sum of C(allele_i + i - 1, i).  So
    the genotypes whose largest allele is v follow each other, in the order of
    those of p - 1 alleles up to v: the array for p is made of beginnings of the
    array for p - 1, each with one more copy where v is ``a``.
    """
    alleles = F.sequence(F.lit(0), n - 1)
    one = F.transform(alleles, lambda v: (v == a).cast("int"))

    def longer(acc, p):
        return F.flatten(F.transform(alleles, lambda v: F.transform(
            F.slice(acc, F.lit(1), n_genotypes(v + 1, p - 1).cast("int")), lambda c: c + (v == a).cast("int"))))

    return F.aggregate(F.filter(F.sequence(F.lit(1), ploidy), lambda p: p > 1), one, longer)


def with_split_pl(df, pl: str = "PL", a_index: str = "a_index", n_alleles: str = "num_alleles",
                  tmp: str = "_pl_pos_a"):
    """PL of a split allele, the minimum per downcoded class, in closed form
    and staged: genotype ``j/k`` sits at ``k(k+1)/2 + j``; those carrying allele
    ``a`` are the ``n`` positions ``gt_index(j, a)``; class 2 is ``a/a``,
    class 1 the others among them, class 0 every remaining position.

    An array that has not the length of two alleles a genotype belongs to the
    ploidy whose number of genotypes it has; its classes are 0 to ploidy copies
    of ``a``.  One that fits no ploidy gives NULL."""
    a, n = F.col(a_index), F.col(n_alleles)
    size = F.size(pl)
    diploid = size == (n * (n + 1) / 2)
    df = df.withColumn(tmp, F.transform(F.sequence(F.lit(0), n - 1), lambda j: gt_index(j, a)))
    aa = gt_index(a, a)
    pl2 = F.get(F.col(pl), aa)
    pl1 = F.array_min(F.transform(F.array_remove(F.col(tmp), aa), lambda i: F.get(F.col(pl), i)))
    pl0 = F.array_min(F.filter(F.col(pl), lambda x, i: ~F.array_contains(F.col(tmp), i)))
    ok = F.col(pl).isNotNull() & (size > 0)
    # other ploidies: what the classes share is a column, computed once a row
    ploidy, copies = f"{tmp}_ploidy", f"{tmp}_copies"
    df = df.withColumn(ploidy, F.when(ok & ~diploid, ploidy_of(size, n)))
    df = df.withColumn(copies, F.when(F.col(ploidy).isNotNull(), copies_by_genotype(n, F.col(ploidy), a)))
    classes = F.when(F.col(copies).isNotNull(), F.transform(F.sequence(F.lit(0), F.col(ploidy)), lambda c: F.array_min(
        F.filter(F.col(pl), lambda x, i: F.get(F.col(copies), i) == c))))
    return df.withColumn(pl, F.when(ok & diploid, F.array(pl0, pl1, pl2)).when(ok, classes)).drop(tmp, ploidy, copies)


def estimated_pl(gt: Column, gq: Column, ad: Column, more: Column | None = None) -> Column:
    """PL estimated from GQ and AD (three genotype classes; NULL for a call of
    more than two alleles, which has more of them).

    ``m = max(GQ, 3*(AD[0]-AD[1]))`` (NULL ignored): hom-ref ``[0,GQ,m]``,
    het ``[GQ,0,m]``, hom-var ``[m,GQ,0]``; missing call -> NULL.  A haploid
    call counts as hom-ref / hom-var by its single allele.
    """
    m = F.greatest(gq, (F.get(ad, 0) - F.get(ad, 1)) * 3)
    zero = F.lit(0)
    none = ~is_called(gt) if more is None else ~is_called(gt) | more.isNotNull()
    return (F.when(none, F.lit(None).cast("array<int>"))
            .when(is_hom_ref(gt), F.array(zero, gq, m))
            .when(is_hom_var(gt), F.array(m, gq, zero))
            .when(is_het(gt), F.array(gq, zero, m))
            .otherwise(F.array(F.lit(None).cast("int"))))
