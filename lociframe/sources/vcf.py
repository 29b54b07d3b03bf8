"""VCF text -> ``sites`` / ``calls`` / ``samples`` DataFrames.

Body lines are split and typed with built-in functions (no Python per row).
A sites-only read caps the split at nine fields, so genotype columns are
never materialised.  Calls are produced by ``posexplode`` of the sample
columns inside the task that read the line (narrow), and joined to the
sample table (one row per sample) for the names.

The header (``##`` lines and ``#CHROM``) is read on the driver by streaming
only the first lines of one file; it is metadata of a few kB, never data.
Block-compressed files (``.bgz``, ``.gz``) are cut into byte ranges; a task
finds the first block of its range and reads lines across block ends, so one
large file is read by many tasks (``sources/blocks.py``).

Every line gets a ``file_id`` and the ``record`` number of its place in that file,
which ``sites`` and ``calls`` both carry: two records may share a variant key, before
or after they are split.  They do not depend on how the file was read, so sites
and calls of different jobs fit together.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.sources import blocks as BL

_META = re.compile(r"^##(INFO|FORMAT|FILTER)=<(.*)>\s*$")
_KV = re.compile(r'([A-Za-z_]+)=("(?:[^"\\]|\\.)*"|[^,]*)')

SPARK_TYPES = {"Integer": "int", "Float": "double", "String": "string", "Character": "string", "Flag": "boolean"}


@dataclass
class VcfHeader:
    meta: list[str] = field(default_factory=list)          # every '##' line, in order
    samples: list[str] = field(default_factory=list)
    info: dict[str, dict] = field(default_factory=dict)    # id -> {Number, Type, Description}
    format: dict[str, dict] = field(default_factory=dict)
    filter: dict[str, dict] = field(default_factory=dict)


def parse_header_lines(lines) -> VcfHeader:
    h = VcfHeader()
    for line in lines:
        line = line.rstrip("\r\n")
        if line.startswith("##"):
            h.meta.append(line)
            m = _META.match(line)
            if m:
                attrs = {k: re.sub(r"\\(.)", r"\1", v[1:-1]) if v.startswith('"') else v
                         for k, v in _KV.findall(m.group(2))}
                section = {"INFO": h.info, "FORMAT": h.format, "FILTER": h.filter}[m.group(1)]
                name = attrs.pop("ID", "")
                section[name] = {"Number": None, "Type": None, "Description": None} | attrs
        elif line.startswith("#CHROM"):
            h.samples = line.split("\t")[9:]
    return h


def contigs_of(header: VcfHeader) -> list[str]:
    """The ids of the ``##contig`` lines, in order."""
    found = (re.match(r"##contig=<(?:.*,)?ID=([^,>]+)", m) for m in header.meta)
    return list(dict.fromkeys(m.group(1) for m in found if m))


def _first_file(spark: SparkSession, path: str) -> str:
    """First file (in name order) under ``path``: the part holding the header
    of a folder written in coordinate order.  Only the listing is read."""
    files = BL.list_files(spark, path).agg(F.min("path").alias("p")).first()
    if files is None or files["p"] is None:
        raise FileNotFoundError(path)
    return files["p"]


def read_header(spark: SparkSession, path: str) -> VcfHeader:
    """Header of the first file under ``path`` (stops at the first record)."""
    return parse_header_lines(BL.head_lines(_first_file(spark, path)))


def check_headers(spark: SparkSession, path: str, header: VcfHeader) -> None:
    """Files under one path must have the same sample columns (parts without a
    header follow the first file's; a single file has nothing to differ from).  Each file's first lines are read in a
    task; other sample columns need ``merge_sample_sets``."""
    def names(batches):
        for pdf in batches:
            found = [(p, next((ln.rstrip("\r\n") for ln in BL.head_lines(p) if ln.startswith("#CHROM")), None)) for p in pdf["path"]]
            yield pd.DataFrame(found, columns=["path", "line"])

    if len(BL.list_files(spark, path).select("path").head(2)) < 2:
        return
    mine = "\t".join(header.samples)
    others = (BL.list_files(spark, path).select("path").mapInPandas(names, "path string, line string")
              .where(F.col("line").isNotNull())
              .where(F.coalesce(F.array_join(F.slice(F.split("line", "\t", -1), 10, F.greatest(F.size(F.split("line", "\t", -1)) - 9, F.lit(0))), "\t"),
                                F.lit("")) != mine))
    odd = others.select("path").head(1)
    if odd:
        raise ValueError(f"{odd[0]['path']} has other sample columns than the first file: read it apart and use merge_sample_sets")


def header_frame(spark: SparkSession, header: VcfHeader) -> DataFrame:
    """Header metadata as rows ``(section, id, number, type, description)``."""
    rows = [(sec, k, v.get("Number"), v.get("Type"), v.get("Description"))
            for sec, d in (("INFO", header.info), ("FORMAT", header.format), ("FILTER", header.filter))
            for k, v in d.items()]
    schema = "section string, id string, number string, type string, description string"
    return spark.createDataFrame(rows, schema)


def samples_frame(spark: SparkSession, header: VcfHeader) -> DataFrame:
    """Samples in genotype-column order: ``(s, ordinal)``."""
    return spark.createDataFrame([(s, i) for i, s in enumerate(header.samples)], "s string, ordinal int")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the file(s): ``(value, file_id, record)``, see ``blocks``."""
    return BL.read_ranges(spark, BL.list_files(spark, path))


def _missing_dot(x: Column) -> Column:
    return F.when(x != ".", x)


def typed_value(value: Column, number: str | None, vtype: str | None) -> Column:
    """A VCF value typed by its header declaration; ``.`` means missing.

    Numbers are cast with ``try_cast`` (element-wise for lists, no lambda):
    ``.`` is not a number and reads NULL.  Text needs the explicit ``.`` test.
    """
    t = SPARK_TYPES.get(vtype or "String", "string")
    scalar = number in ("1", "0") and vtype != "Flag"
    if t != "string":
        if scalar:
            return value.try_cast(t)
        return F.when(value != ".", F.split(value, ",", -1).try_cast(f"array<{t}>"))
    if scalar:
        return _missing_dot(value)
    return F.when(value.isNotNull() & (value != "."),
                  F.transform(F.split(value, ",", -1), lambda x: _missing_dot(x)))


def info_struct(info_text: Column, header: VcfHeader) -> Column:
    """The declared INFO fields; of a key that a record repeats, the first
    value counts."""
    padded = F.concat(F.lit(";"), info_text, F.lit(";"))
    fields = []
    for fid, d in header.info.items():
        at = F.locate(f";{fid}=", padded)
        if d.get("Type") == "Flag":
            fields.append(((F.locate(f";{fid};", padded) > 0) | (at > 0)).alias(fid))
        else:
            text = F.when(at > 0, F.substring_index(F.substr(padded, at + len(fid) + 2), ";", 1))
            fields.append(typed_value(text, d.get("Number"), d.get("Type")).alias(fid))
    if not fields:
        return F.struct(F.lit(None).cast("string").alias("_empty"))
    return F.struct(*fields)


def _record(lines: DataFrame) -> list[str]:
    return [c for c in ("file_id", "record") if c in lines.columns]


def _body(lines: DataFrame, find_replace: tuple[str, str] | None) -> DataFrame:
    v = F.col("value")
    if find_replace:
        v = F.regexp_replace(v, find_replace[0], find_replace[1])
    return lines.select(*_record(lines), v.alias("value")).where(~F.col("value").startswith("#") & (F.length("value") > 0))


def parse_sites(lines: DataFrame, header: VcfHeader, find_replace: tuple[str, str] | None = None,
                max_fields: int = 9) -> DataFrame:
    """Site columns of every record: ``contig, position, rsid, alleles, qual,
    filters, info``.  ``max_fields=9`` leaves the sample columns unsplit."""
    parts = F.split(F.col("value"), "\t", max_fields)

    def f(i):
        return F.get(parts, i)
    alt = f(4)
    alleles = F.concat(F.array(f(3)), F.when(alt == ".", F.array().cast("array<string>"))
                       .otherwise(F.split(alt, ",", -1)))
    return _body(lines, find_replace).select(
        *_record(lines), f(0).alias("contig"), f(1).cast("long").alias("position"), _missing_dot(f(2)).alias("rsid"),
        alleles.alias("alleles"), _missing_dot(f(5)).try_cast("double").alias("qual"),
        F.when(f(6) != ".", F.split(f(6), ";", -1)).alias("filters"),
        info_struct(f(7), header).alias("info"))


def gt_struct(text: Column) -> Column:
    """GT text (``0/1``, ``1|0``, ``1``, ``0/0/1``) -> call struct.  The ploidy is the
    number of parts; a call with any missing part (``./.``, ``0/.``) is missing as a
    whole.  One-character separators split without a regex."""
    parts = F.split(F.translate(text, "|", "/"), "/", -1)
    a1 = F.get(parts, 0).try_cast("int")
    a2 = F.get(parts, 1).try_cast("int")
    more = F.when(F.size(parts) > 2, F.slice(parts, 3, F.size(parts) - 2).try_cast("array<int>"))
    whole = (a1.isNotNull() & ((F.size(parts) == 1) | a2.isNotNull())
             & ((F.size(parts) < 3) | F.forall(more, lambda x: x.isNotNull())))
    return F.when(whole, F.struct(a1.alias("a1"), a2.alias("a2"), (F.instr(text, "|") > 0).alias("phased"), more.alias("more")))


def parse_calls(lines: DataFrame, header: VcfHeader, samples: DataFrame,
                find_replace: tuple[str, str] | None = None) -> DataFrame:
    """Long-form calls: variant key + ``s`` + one column per FORMAT field
    (``GT`` as a call struct; ``PGT`` stays text).

    Per line: the FORMAT key positions; per call: one split of the sample
    text, raw field texts, then typing (staged so nothing is re-evaluated).
    """
    parts = F.split(F.col("value"), "\t", -1)

    def f(i):
        return F.get(parts, i)
    alt = f(4)
    alleles = F.concat(F.array(f(3)), F.when(alt == ".", F.array().cast("array<string>"))
                       .otherwise(F.split(alt, ",", -1)))
    fids = list(header.format)
    keys = F.split(f(8), ":", -1)
    rid = _record(lines)
    base = _body(lines, find_replace).select(
        *rid, f(0).alias("contig"), f(1).cast("long").alias("position"), alleles.alias("alleles"),
        *[F.array_position(keys, F.lit(fid)).cast("int").alias(f"_p{i}") for i, fid in enumerate(fids)],
        F.posexplode(F.slice(parts, 10, F.greatest(F.size(parts) - 9, F.lit(0)))).alias("ordinal", "_text"))
    vals = base.withColumn("_v", F.split(F.col("_text"), ":", -1)).drop("_text")
    raw = vals.select(*rid, "contig", "position", "alleles", "ordinal",
                      *[F.get(F.col("_v"), F.col(f"_p{i}") - 1).alias(f"_r{i}") for i in range(len(fids))])
    cols = []
    for i, fid in enumerate(fids):
        d = header.format[fid]
        r = F.col(f"_r{i}")
        cols.append((gt_struct(r) if fid == "GT" else typed_value(r, d.get("Number"), d.get("Type"))).alias(fid))
    out = raw.select(*rid, "contig", "position", "alleles", "ordinal", *cols)
    # the sample table is the header's own sample list, which the driver holds
    # already: broadcast it so the calls never shuffle
    return out.join(F.broadcast(samples), "ordinal").drop("ordinal")


@dataclass
class Vcf:
    header: VcfHeader
    sites: DataFrame
    calls: DataFrame | None
    samples: DataFrame


def read_vcf(spark: SparkSession, path: str, drop_samples: bool = False,
             find_replace: tuple[str, str] | None = None, header: VcfHeader | None = None) -> Vcf:
    """Read VCF file(s): sites always; calls unless ``drop_samples``.
    ``find_replace`` is a Java regular expression and its replacement, applied to
    every record's text (``.`` matches any character; quote it as ``\\\\.``)."""
    header = header or read_header(spark, path)
    if not drop_samples:
        check_headers(spark, path, header)
    lines = read_lines(spark, path)
    samples = samples_frame(spark, header)
    sites = parse_sites(lines, header, find_replace)
    calls = None if drop_samples else parse_calls(lines, header, samples, find_replace)
    return Vcf(header, sites, calls, samples)


def parse_lines(spark: SparkSession, lines: DataFrame, header_lines: list[str], drop_samples: bool = False,
                find_replace: tuple[str, str] | None = None) -> Vcf:
    """Same as ``read_vcf`` for a DataFrame of lines already in Spark."""
    header = parse_header_lines(header_lines)
    samples = samples_frame(spark, header)
    sites = parse_sites(lines, header, find_replace)
    calls = None if drop_samples else parse_calls(lines, header, samples, find_replace)
    return Vcf(header, sites, calls, samples)
