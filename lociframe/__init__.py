"""lociframe: genomic variant call sets as Spark DataFrames."""

__version__ = "0.1.0"

__all__ = ["get_spark", "read_vcf", "write_vcf", "split_multi", "split_calls", "annotate_sites",
           "annotate_extra", "ExtraTables"]


def __getattr__(name):  # lazy: importing the package does not start Spark
    if name == "get_spark":
        from lociframe.session import get_spark
        return get_spark
    if name == "read_vcf":
        from lociframe.sources.vcf import read_vcf
        return read_vcf
    if name == "write_vcf":
        from lociframe.sinks.vcf import write_vcf
        return write_vcf
    if name in ("split_multi", "split_calls"):
        from lociframe.operators import split
        return getattr(split, name)
    if name == "annotate_sites":
        from lociframe.plans.annotate import annotate_sites
        return annotate_sites
    if name in ("annotate_extra", "ExtraTables"):
        from lociframe.plans import extra
        return getattr(extra, name)
    raise AttributeError(name)
