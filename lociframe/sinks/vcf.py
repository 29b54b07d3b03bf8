"""``sites`` (+ ``calls``) -> VCF text.

Records are rendered with built-in string functions.  Genotype columns need
the wide layout, so calls are grouped per variant (one entry per sample:
the group size is bounded by the cohort size, not by the data) and absent
samples are filled with missing values.  Output is written as text parts in
coordinate order with the header in the first part (the parts concatenate
to one valid VCF), or one folder per shard with the header in every shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.functions.alleles import contig_order, row_key
from lociframe.functions.genotype import more_of
from lociframe.sinks.blocks import join_block_gzip, write_block_gzip
from lociframe.sources.vcf import VcfHeader, contigs_of

FORMAT_ORDER = ["GT", "AD", "DP", "GQ", "PL", "PGT"]


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("."))


def value_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.when(col.isNotNull(), F.array_join(F.transform(col, lambda x: _text(x)), ","))
    return col.cast("string")


def info_text(sites: DataFrame) -> Column:
    """``K=V;...`` from the INFO struct (flags by name, NULL fields left out)."""
    if "info" not in sites.columns:
        return F.lit(".")
    parts = []
    for fld in sites.schema["info"].dataType.fields:
        c = F.col("info")[fld.name]
        if isinstance(fld.dataType, T.BooleanType):
            parts.append(F.when(c, F.lit(fld.name)))
        else:
            parts.append(F.concat(F.lit(fld.name + "="), value_text(c, fld.dataType)))
    joined = F.concat_ws(";", *parts)
    return F.when(joined == "", F.lit(".")).otherwise(joined)


def gt_text(gt: Column, more: Column | None = None) -> Column:
    sep = F.when(gt["phased"], F.lit("|")).otherwise(F.lit("/"))
    two = F.concat(gt["a1"].cast("string"), sep, gt["a2"].cast("string"))
    if more is not None:
        rest = more.cast("array<string>")
        two = (F.when(more.isNull(), two).when(gt["phased"], F.concat(two, sep, F.array_join(rest, "|")))
               .otherwise(F.concat(two, sep, F.array_join(rest, "/"))))
    return (F.when(gt.isNull() | gt["a1"].isNull(), F.lit("./."))
            .when(gt["a2"].isNull(), gt["a1"].cast("string"))
            .otherwise(two))


def format_keys(calls: DataFrame) -> list[str]:
    present = [c for c in FORMAT_ORDER if c in calls.columns]
    return present


def sample_text(calls: DataFrame, keys: list[str]) -> Column:
    parts = []
    for k in keys:
        if k == "GT":
            parts.append(gt_text(F.col("GT"), more_of(calls)))
        else:
            parts.append(_text(value_text(F.col(k), calls.schema[k].dataType)))
    return F.concat_ws(":", *parts)


def missing_sample_text(keys: list[str]) -> str:
    return ":".join("./." if k == "GT" else "." for k in keys)


def record_lines(sites: DataFrame, calls: DataFrame | None = None, samples: DataFrame | None = None,
                 key=None, n_samples: int | None = None, carry=()) -> DataFrame:
    """One text line per record, next to its key columns and those of
    ``carry``.  A record's calls are sorted by sample column and the gaps
    between them filled in one pass (linear in the samples)."""
    key = list(key or (row_key(sites) if calls is None else row_key(sites, calls)))
    alts = F.slice("alleles", 2, F.size("alleles") - 1)
    fixed = [F.col("contig"), F.col("position").cast("string"),
             F.coalesce(F.col("rsid"), F.lit(".")) if "rsid" in sites.columns else F.lit("."),
             F.col("alleles")[0],
             F.when(F.size(alts) > 0, F.array_join(alts, ",")).otherwise(F.lit(".")),
             _text(F.col("qual")) if "qual" in sites.columns else F.lit("."),
             F.when(F.size("filters") > 0, F.array_join("filters", ";")).otherwise(F.lit("."))
             if "filters" in sites.columns else F.lit("."),
             info_text(sites)]
    carry = [c for c in carry if c not in key]
    body = sites.select(*key, *carry, F.concat_ws("\t", *fixed).alias("_site"))
    if calls is None:
        return body.select(*key, *carry, F.col("_site").alias("line"))
    keys = format_keys(calls)
    if n_samples is None:
        n_samples = samples.count()
    cells = (calls.join(samples.select("s", "ordinal"), "s")
             .select(*key, "ordinal", sample_text(calls, keys).alias("_txt")))
    grouped = cells.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("ordinal", "_txt"))).alias("_all"))
    before = lambda i: F.coalesce(F.get(F.col("_all"), i - 1)["ordinal"], F.lit(-1))
    # of calls repeated for one sample the first counts
    grouped = grouped.withColumn("_all", F.filter("_all", lambda x, i: x["ordinal"] > before(i)))
    miss = missing_sample_text(keys)
    filled = F.transform("_all", lambda x, i: F.concat(F.repeat(F.lit(miss + "\t"), x["ordinal"] - before(i) - 1), x["_txt"]))
    last = F.coalesce(F.element_at("_all", -1)["ordinal"], F.lit(-1))
    wide = F.concat(F.array_join(filled, "\t"), F.repeat(F.lit("\t" + miss), F.lit(n_samples - 1) - last))
    none = F.repeat(F.lit("\t" + miss), F.lit(n_samples))
    out = body.join(grouped.select(*key, wide.alias("_wide")), key, "left")
    return out.select(*key, *carry, F.concat(F.concat_ws("\t", F.col("_site"), F.lit(":".join(keys))),
                                             F.coalesce(F.concat(F.lit("\t"), F.col("_wide")), none)).alias("line"))


def _quoted(text: str | None) -> str:
    return '"' + (text or "").replace("\\", "\\\\").replace('"', '\\"') + '"'


def _declaration(section: str, name: str, attrs: dict) -> str:
    """An INFO, FORMAT or FILTER line; attributes beyond the usual ones follow."""
    plain = [] if section == "FILTER" else [f"Number={attrs.get('Number')}", f"Type={attrs.get('Type')}"]
    more = [f"{k}={_quoted(v)}" for k, v in attrs.items() if k not in ("Number", "Type", "Description")]
    return f"##{section}=<" + ",".join([f"ID={name}", *plain, f"Description={_quoted(attrs.get('Description'))}", *more]) + ">"


def header_lines(header: VcfHeader, samples: list[str] | None = None, with_format: bool = True) -> list[str]:
    """``##`` lines (INFO/FORMAT/FILTER regenerated from the header dicts,
    other meta lines kept) and the ``#CHROM`` line."""
    keep = [m for m in header.meta if not m.startswith(("##INFO=", "##FORMAT=", "##FILTER=", "##fileformat"))]
    out = ["##fileformat=VCFv4.2"]
    for sec, declared in (("FILTER", header.filter), ("INFO", header.info), ("FORMAT", header.format)):
        out += [_declaration(sec, name, attrs) for name, attrs in declared.items()]
    out += keep
    cols = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"]
    smp = header.samples if samples is None else samples
    if with_format and smp:
        cols += ["FORMAT"] + list(smp)
    out.append("\t".join(cols))
    return out


ORDER = ["_o", "_contig", "position", "_ref", "_alt"]


def _placed(spark: SparkSession, recs: DataFrame, header: VcfHeader, build: str) -> DataFrame:
    """Records with the columns of ``ORDER``: contigs in the order of the header's
    ``##contig`` lines (of the build where it has none), others last and by name,
    so that each contig's records stand together."""
    last = F.lit(1 << 20)
    listed = contigs_of(header)
    if listed:
        # the header's own list, which the driver has read
        ranks = spark.createDataFrame(list(zip(listed, range(len(listed)))), "_c string, _rank int")
        recs = recs.join(F.broadcast(ranks), F.col("contig") == F.col("_c"), "left")
        rank = F.col("_rank")
    else:
        rank = contig_order(build)
    return recs.select("*", F.coalesce(rank, last).alias("_o"), F.when(rank.isNull(), F.col("contig")).otherwise("").alias("_contig"),
                       F.col("alleles")[0].alias("_ref"), F.array_join(F.slice("alleles", 2, F.size("alleles") - 1), ",").alias("_alt"))


def vcf_lines(spark: SparkSession, header: VcfHeader, sites: DataFrame, calls: DataFrame | None = None,
              samples: DataFrame | None = None, build: str = "GRCh38") -> DataFrame:
    """Header + records with a sort key: ``ORDER`` and ``line``."""
    smp_names = [r["s"] for r in samples.orderBy("ordinal").collect()] if samples is not None else []
    recs = record_lines(sites, calls, samples, n_samples=len(smp_names) if samples is not None else None)
    body = _placed(spark, recs, header, build).select(*ORDER, "line")
    head = header_lines(header, smp_names if calls is not None else [], with_format=calls is not None)
    hdf = spark.createDataFrame([(-1 - (len(head) - i), "", 0, "", "", ln) for i, ln in enumerate(head)],
                                "_o int, _contig string, position long, _ref string, _alt string, line string")
    return hdf.unionByName(body)


def write_vcf(spark: SparkSession, header: VcfHeader, sites: DataFrame, path: str,
              calls: DataFrame | None = None, samples: DataFrame | None = None,
              build: str = "GRCh38", compression: str = "gzip") -> None:
    """Coordinate-sorted VCF as ordered text parts (header in the first)."""
    lines = vcf_lines(spark, header, sites, calls, samples, build)
    (lines.orderBy(*ORDER).select("line")
     .write.mode("overwrite").option("compression", compression).text(path))


def write_vcf_bgz(spark: SparkSession, header: VcfHeader, sites: DataFrame, path: str, scratch: str,
                  calls: DataFrame | None = None, samples: DataFrame | None = None, build: str = "GRCh38") -> int:
    """Coordinate-sorted VCF as one block-gzip file: parts are written below the
    folder ``scratch`` (shared by the tasks, removed by the caller) and joined by
    bytes.  Returns the file's size."""
    lines = vcf_lines(spark, header, sites, calls, samples, build).orderBy(*ORDER).select("line")
    return join_block_gzip(write_block_gzip(lines, scratch), path)


def shard_lines(header: VcfHeader, sites: DataFrame, shard_col: str, calls: DataFrame | None = None, samples: DataFrame | None = None,
                build: str = "GRCh38") -> DataFrame:
    """``(shard, *ORDER, line)``: every shard's header lines, then its records."""
    smp_names = [r["s"] for r in samples.orderBy("ordinal").collect()] if samples is not None else []
    recs = record_lines(sites, calls, samples, n_samples=len(smp_names) if samples is not None else None, carry=[shard_col])
    body = (_placed(sites.sparkSession, recs, header, build)
            .select(F.col(shard_col).cast("string").alias("shard"), *ORDER, "line"))
    head = header_lines(header, smp_names if calls is not None else [], with_format=calls is not None)
    # every shard gets the header lines (a generator per shard id, no join)
    heads = (sites.select(F.col(shard_col).cast("string").alias("shard")).distinct()
             .select("shard", F.posexplode(F.array(*[F.lit(x) for x in head])).alias("_i", "line"))
             .select("shard", (F.col("_i") - len(head)).cast("int").alias("_o"), F.lit("").alias("_contig"),
                     F.lit(0).cast("long").alias("position"), F.lit("").alias("_ref"), F.lit("").alias("_alt"), "line"))
    return heads.unionByName(body)


def write_vcf_shards(spark: SparkSession, header: VcfHeader, sites: DataFrame, shard_col: str, path: str,
                     calls: DataFrame | None = None, samples: DataFrame | None = None,
                     build: str = "GRCh38", compression: str = "gzip") -> bool:
    """One folder per shard (``shard=<id>``) whose parts, in name order, are one
    complete VCF with its own header.  Writes nothing and returns False when
    there are no records.  Rows are dealt by ranges of (shard, coordinate), so
    a large shard is written by several tasks and small ones share a task."""
    if sites.isEmpty():
        return False
    order = ["shard", *ORDER]
    (shard_lines(header, sites, shard_col, calls, samples, build).repartitionByRange(*order).sortWithinPartitions(*order)
     .select("shard", "line").write.mode("overwrite").partitionBy("shard").option("compression", compression).text(path))
    return True
