"""Delimited and Parquet inputs: text tables, BED intervals, gene / sample
lists, pedigrees, stored matrix tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators.intervals import valid_intervals


def read_tsv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Tab-separated table with every column as text (no type inference)."""
    return spark.read.csv(path, sep="\t", header=header, inferSchema=False)


def parse_bed_lines(lines: DataFrame, build: str | None = None, skip_invalid: bool = True) -> DataFrame:
    """BED text lines -> ``contig, start0, end0, target``.

    A header line (or any line) whose start is not an integer is not an
    interval and is dropped, so files with and without a header read the
    same; ``track``/``browser``/``#`` lines likewise.  Columns beyond the
    fourth are ignored; a missing fourth column gives ``target = NULL``.
    Invalid intervals (negative, empty, contig outside the build) are
    skipped when ``skip_invalid``.
    """
    v = F.col("value")
    f = F.split(v, "\t", -1)
    out = (lines.where(~v.startswith("#") & ~v.startswith("track") & ~v.startswith("browser") & (F.length(v) > 0))
           .select(F.get(f, 0).alias("contig"),
                   F.get(f, 1).try_cast("long").alias("start0"),
                   F.get(f, 2).try_cast("long").alias("end0"),
                   F.get(f, 3).alias("target"))
           .where(F.col("start0").isNotNull() & F.col("end0").isNotNull()))
    return valid_intervals(out, build) if skip_invalid else out


def read_bed(spark: SparkSession, path: str, build: str | None = None, skip_invalid: bool = True) -> DataFrame:
    return parse_bed_lines(spark.read.text(path), build, skip_invalid)


def read_list(spark: SparkSession, path: str, col: str = "value") -> DataFrame:
    """One value per line (first tab-separated field), e.g. genes or samples."""
    return (spark.read.text(path).select(F.get(F.split("value", "\t", -1), 0).alias(col))
            .where(F.length(col) > 0))


def list_name(path: str) -> str:
    """The label a gene list carries: its file's base name."""
    return os.path.basename(path.rstrip("/"))


PEDIGREE_COLUMNS = ["family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype"]


def read_pedigree(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """First six columns of a pedigree file, renamed to the standard names."""
    df = read_tsv(spark, path, header=header)
    return df.select(*df.columns[:6]).toDF(*PEDIGREE_COLUMNS)


def read_matrix_table(spark: SparkSession, path: str, n_partitions: int | None = None):
    """A stored call set: ``<path>/sites`` and ``<path>/calls`` Parquet folders
    (optionally range-partitioned by locus into ``n_partitions``)."""
    sites = spark.read.parquet(os.path.join(path, "sites"))
    calls = spark.read.parquet(os.path.join(path, "calls"))
    if n_partitions:
        sites = sites.repartitionByRange(n_partitions, "contig", "position")
        calls = calls.repartitionByRange(n_partitions, "contig", "position")
    return sites, calls


def read_bucketed(spark: SparkSession, name: str, path: str, buckets: int, by=("contig", "position")) -> DataFrame:
    """A table that ``sinks.tables.write_bucketed`` stored at ``path``, registered in
    this session's catalog as ``name`` (the files do not say how they were dealt:
    give the numbers that they were written with)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
