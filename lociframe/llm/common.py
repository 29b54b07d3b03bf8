"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.session import ensure_checkpoint_dir

PART = 1 << 20            # bytes of text worked on at a time
_SPACE = re.compile(rb"[\t-\r ]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a narrow intermediate to the shared folder and read it back: the
    lineage ends there, and Spark knows its size when it plans the next join."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the folders of ``stored`` tables that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


SMALL = 1_000_000         # rows of a few numbers or short texts that may be broadcast


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table, marked for broadcast if it has at most ``SMALL`` rows."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= SMALL else df


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]


def small_hash(h: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash is among the smallest: about four times as many as
    ``wanted`` of ``total`` rows are, so that what partitions hand on to pick the
    ``wanted`` smallest does not grow with their number."""
    share = min(1.0, 4 * wanted / max(total, 1))
    return h <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_docs: int,
                    max_chars: int) -> list[tuple[str, int]]:
    """At most ``max_docs`` labelled training rows for the driver, each text of
    at most ``max_chars`` characters (longer rows do not train); the rows with
    the smallest hash of their id, so that runs agree whatever the partitions.
    ``learn`` (over ``doc_id``) chooses the rows that may be learnt from; rows
    with a null text, id or label train nothing, and a repeated id counts once."""
    y = (labels.select(F.col("doc_id").alias("l_id"), F.col(label).cast("int").alias("y"))
         .where(F.col("l_id").isNotNull() & F.col("y").isin(0, 1)).groupBy("l_id").agg(F.max("y").alias("y")))
    # the few ids are chosen first, on narrow rows; texts are fetched for those only
    total = y.count()
    y = y.where(small_hash(F.xxhash64("l_id"), max_docs, total))
    narrow = (docs.where(learn & F.col("text").isNotNull() & (F.length("text") <= max_chars))
              .select("doc_id").join(y, F.col("doc_id") == F.col("l_id")).select("doc_id", "y").distinct()
              .withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(max_docs))
    chosen = stored(narrow, "training-ids")
    rows = (docs.where(F.length("text") <= max_chars).select(F.col("doc_id").alias("d_id"), "text")
            .join(chosen, F.col("d_id") == F.col("doc_id")).select("h", "doc_id", "text", "y").collect())
    once = {}
    for r in sorted(rows, key=lambda r: (r["h"], r["doc_id"], r["text"])):
        once.setdefault(r["doc_id"], (r["text"], int(r["y"])))
    return list(once.values())


def parts(data: bytes, size: int = PART) -> Iterator[bytes]:
    """``data`` in pieces that end at white space (longer where there is none)."""
    at = 0
    while at < len(data):
        end = _SPACE.search(data, at + size) if at + size < len(data) else None
        to = end.start() if end else len(data)
        yield data[at:to]
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
