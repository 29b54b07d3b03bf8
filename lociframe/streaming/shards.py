"""Structured Streaming ingestion of VCF shards.

Shards that land in a folder (the scatter step of a large run) are parsed,
split into bi-allelic rows and appended to a Parquet table as they arrive.
The stream is stateless (each record is handled on its own), so it needs no
watermark; the checkpoint location makes it restartable exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociframe.operators.cohort import add_cohort_ac_af
from lociframe.operators.split import split_multi
from lociframe.sources.vcf import VcfHeader, parse_sites


def split_sites_stream(spark: SparkSession, in_dir: str, header: VcfHeader,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of split sites from text VCF shards (plain or
    ``.gz``) appearing in ``in_dir``; header lines are skipped."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    sites = split_multi(parse_sites(reader.load(in_dir), header))
    return add_cohort_ac_af(sites) if {"AC", "AF"} <= set(header.info) else sites


def start_split_sites(spark: SparkSession, in_dir: str, header: VcfHeader, out_dir: str,
                      checkpoint: str, once: bool = False):
    """Append split sites to Parquet at ``out_dir``; returns the query."""
    stream = split_sites_stream(spark, in_dir, header)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", out_dir).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()


def annotate_sites_stream(stream_sites: DataFrame, scores: list[tuple[DataFrame, dict[str, str]]] = (),
                          intervals: DataFrame | None = None, build: str = "GRCh38") -> DataFrame:
    """Site-level enrichment of a stream of split sites: each score table is
    a stream-static left join (the static side reduced to one row per key),
    the interval label a stream-static join with the labelled segments.
    Each micro-batch is handled on its own; no streaming state is kept."""
    from lociframe.operators.intervals import interval_label, valid_intervals
    from lociframe.operators.lookup import lookup_by_variant
    out = stream_sites
    for table, fields in scores:
        out = lookup_by_variant(out, table, fields)
    if intervals is not None:
        out = interval_label(out, valid_intervals(intervals, build))
    return out


def start_annotated_sites(spark: SparkSession, in_dir: str, header: VcfHeader, out_dir: str, checkpoint: str,
                          scores: list[tuple[DataFrame, dict[str, str]]] = (), intervals: DataFrame | None = None,
                          once: bool = False):
    """Split and enrich arriving shards, appending to Parquet at ``out_dir``."""
    stream = annotate_sites_stream(split_sites_stream(spark, in_dir, header), scores, intervals)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", out_dir).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer
    return writer.start()
