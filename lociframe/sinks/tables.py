"""Table sinks: TSV, stored call sets, per-chunk lists."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def write_tsv(df: DataFrame, path: str, header: bool = True, single_file: bool = False) -> None:
    """Tab-separated text with a header.  ``single_file`` funnels the rows
    through one task and is meant only for small reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, sep="\t", header=header)


def write_matrix_table(sites: DataFrame, calls: DataFrame | None, path: str) -> None:
    """Store a call set as Parquet (``sites`` and ``calls`` side by side);
    callers choose the path (e.g. a dated folder)."""
    sites.write.mode("overwrite").parquet(os.path.join(path, "sites"))
    if calls is not None:
        calls.write.mode("overwrite").parquet(os.path.join(path, "calls"))


#: what bucketed tables are dealt and sorted by
BUCKETED_BY = ("contig", "position")


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, by=BUCKETED_BY) -> DataFrame:
    """Store a table at ``path`` in ``buckets`` buckets by ``by``, each sorted by them,
    under the catalog name ``name``, and return it.

    Tables stored with the same buckets are joined on these columns, and grouped
    by them, without a shuffle; further columns in the join's condition or the
    grouping key do no harm (``spark.sql.requireAllClusterKeysForCoPartition`` is
    off in sessions of ``get_spark``).  Store calls as they are joined: split calls
    have positions of their own.  Rows move once, here; one file per bucket and
    range of rows comes from the repartitioning by the same columns."""
    (df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path)
     .format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def write_chunk_lists(members: DataFrame, chunk_col: str, value_col: str, path: str) -> None:
    """One folder per chunk (``<chunk_col>=<id>``) holding its members, one per line."""
    (members.select(chunk_col, value_col).repartition(chunk_col)
     .sortWithinPartitions(chunk_col, value_col)
     .write.mode("overwrite").partitionBy(chunk_col).text(path))
