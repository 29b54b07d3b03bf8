"""SimHash near-duplicates by multi-index hashing.

1. ``fingerprints``: one 64-bit SimHash per row, map-only.
2. ``links``: the distinct fingerprints are cut into segments.  If two
   fingerprints differ in at most d bits, some segment differs in at most its
   share of d; so each fingerprint probes the small Hamming ball around each of
   its segments in a table keyed by segment value, and the complete distance
   of every match is verified.
3. ``components``: connected components of the links (alternating large and
   small stars), lineage cut in the shared folder after each round.

Exact copies collapse before step 2, so a group of copies is one fingerprint.
A table bucket of more than ``bucket_limit`` fingerprints would pair them all;
such buckets leave the table, and every fingerprint near one of them is
looked up by its complete value instead: it is filed under each value within
half of d bits, and the fingerprints filed under one value (at most a Hamming
ball) are chained to the smallest.  Two fingerprints within d bits share such a
value, and two under one value are within d bits, so no link is lost and none
is invented; the cost is linear in the bucket.

Defined results: a null text is an empty text; no words give fingerprint 0,
which links like any other; repeated rows are separate rows of one component;
rows with a null id are returned, and a component without any id has a null
``component_id``; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read, so further columns never clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import stored, texts

SEED = 42
BLOCK = 1 << 15          # shingles hashed at a time
BITS = 64


def simhash(text: str, shingle: int) -> int:
    """The unsigned fingerprint of one text; counts are kept in blocks, so a
    text of any length needs a bounded amount of memory beside its words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        part = words[at:to + shingle - 1]
        if n == 1:
            hashes = [digest(b" ".join(part), SEED)]
        else:
            buffer = b" ".join(part)
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            starts = (ends - np.fromiter(map(len, part), np.int64, len(part)) - 1).tolist()
            stops = (ends[shingle - 1:] - 1).tolist()
            hashes = [digest(buffer[a:b], SEED) for a, b in zip(starts, stops)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in range(BITS) if 2 * int(ones[i]) > n))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp, text_key): fp as a signed long, text_key a hash of the text."""
    def run(batches):
        for b in batches:
            fps = np.array([simhash(t, shingle) for t in texts(b.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), b.column(2)],
                                             names=["doc_id", "fp", "text_key"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"),
                         F.xxhash64("text").alias("text_key"))
    return narrow.mapInArrow(run, "doc_id long, fp long, text_key long")


def ball(width: int, radius: int) -> list[int]:
    """XOR masks of the Hamming ball (width bits, at most ``radius`` set)."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _masks(width: int, radius: int) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in ball(width, radius)])


def _plan(max_distance: int, segments: int) -> list[tuple[int, int, int, int]]:
    """(segment, shift, width, radius), the radii just large enough that a pair
    within ``max_distance`` must meet in one segment; radius -1: not probed."""
    base, extra = divmod(max_distance, segments)
    cuts = [BITS * i // segments for i in range(segments + 1)]
    return [(i, cuts[i], cuts[i + 1] - cuts[i], base if i <= extra else base - 1) for i in range(segments)]


def _key(segment: int, value: Column, segments: int) -> Column:
    # segments share one key column: the segment number above the value's bits
    width = -(-BITS // segments)
    return value.bitwiseOR(F.lit(segment << width)) if segments > 1 else value


def links(fps: DataFrame, max_distance: int = 2, segments: int = 2, bucket_limit: int = 64) -> DataFrame:
    """Links (a, b) among the distinct ``fp`` that connect exactly those within
    ``max_distance`` bits (pairs inside an overfull bucket as chains)."""
    if segments < 2 or not 0 <= max_distance < 16:
        raise ValueError("segments must be at least 2 and max_distance below 16")
    plan = [p for p in _plan(max_distance, segments) if p[3] >= 0]

    def value(shift: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))

    def one(seg: int, shift: int, width: int, radius: int, probing: bool) -> Column:
        own = value(shift, width)
        keys = F.transform(_masks(width, radius), lambda m: own.bitwiseXOR(m))
        if probing:  # of two different values, the smaller one probes the larger
            keys = F.filter(keys, lambda k: k >= own)
        return F.transform(keys, lambda k: F.struct(_key(seg, k, segments).alias("key"),
                                                    _key(seg, own, segments).alias("own")))

    def entries(probing: bool) -> Column:
        return F.concat(*[one(seg, shift, width, radius if probing else 0, probing)
                          for seg, shift, width, radius in plan])

    table = fps.select("fp", F.explode(entries(False)).alias("e")).select("fp", "e.key")
    full = stored(table.groupBy("key").count().where(F.col("count") > bucket_limit).select("key"), "full-buckets")
    near_full = F.concat(*[
        F.when(F.shiftrightunsigned("key", -(-BITS // segments)) == seg,
               F.transform(_masks(width, radius), lambda m: F.col("key").bitwiseXOR(m)))
        .otherwise(F.array().cast("array<long>")) for seg, _, width, radius in plan])
    near_full = full.select(F.explode(near_full).alias("key")).distinct()

    # the usual way: table matches, then the complete distance
    probes = fps.select(F.col("fp").alias("p"), F.explode(entries(True)).alias("e")).select("p", "e.key", "e.own")
    small = table.join(full, "key", "left_anti")
    probes = probes.join(full.withColumnRenamed("key", "full_key"), F.col("own") == F.col("full_key"), "left_anti")
    differ = F.bit_count(F.col("p").bitwiseXOR(F.col("fp")))
    pairs = (probes.join(small, "key").where((F.col("p") != F.col("fp")) & (differ <= max_distance))
             .select(F.least("p", "fp").alias("a"), F.greatest("p", "fp").alias("b")))

    # fingerprints near an overfull bucket: filed under complete values
    rest = table.join(near_full, "key", "left_semi").select("fp").distinct()
    half, other = max_distance // 2, max_distance - max_distance // 2
    filed = rest.select("fp", F.explode(F.transform(_masks(BITS, other), lambda m: F.col("fp").bitwiseXOR(m))).alias("v"))
    anchor = F.when(F.bit_count(F.col("fp").bitwiseXOR(F.col("v"))) <= half, F.col("fp"))
    chains = (filed.groupBy("v").agg(F.min(anchor).alias("a"), F.collect_set("fp").alias("fs"))
              .where(F.col("a").isNotNull() & (F.size("fs") > 1))
              .select("a", F.explode("fs").alias("b")).where("a <> b")
              .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return pairs.unionByName(chains).distinct()


def are_stars(edges: DataFrame) -> bool:
    """Whether every node is the ``a`` of one edge and no ``b``, or only a ``b``."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("low")),
                                          F.struct(F.col("b").alias("node"), F.lit(0).alias("low")))).alias("e"))
    return ends.groupBy("e.node").agg(F.sum("e.low").alias("low"), F.count("*").alias("n")).where("low > 0 and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with
    an edge.  Alternating large and small stars until nothing but stars is left;
    every round is a few grouped joins over the edges, stored in the shared folder."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                              F.struct("a", F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.*").where("a <> b").distinct(), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id, text_key, root) for every row of ``docs``;
    ``root`` is a fingerprint that names the component, whatever its ids."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = stored(components(links(nodes.select("fp"), max_distance)), "roots")
    placed = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = placed.join(smallest, "root").select(F.col("fp").alias("node_fp"), "component_id", "root")
    return (fps.join(of_fp, F.col("fp") == F.col("node_fp"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_key", "root"))


def keep_one_of_each(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: that of the smallest
    (id, hash of the text), rows without an id last; of rows that repeat both, any
    one.  All columns are kept."""
    found = near_duplicates(docs, shingle, max_distance).groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "copies")).alias("k")
    kept = stored(found.groupBy("root").agg(first).select(F.col("k.doc_id").alias("kept_id"), F.col("k.text_key").alias("kept_key"), "k.copies"), "kept")
    key = F.xxhash64(docs["text"])

    def rows(of: DataFrame) -> DataFrame:  # the frames' own columns: other names may clash
        return docs.join(of, docs["doc_id"].eqNullSafe(of["kept_id"]) & (key == of["kept_key"]), "left_semi")

    # only rows that are repeated as a whole have to meet once more
    repeated = rows(stored(kept.where("copies > 1"), "repeated"))
    once = (repeated.select(F.struct("doc_id", F.xxhash64("text")).alias("k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"))
            .dropDuplicates(["k"]).select("r.*"))
    return rows(kept.where("copies = 1")).unionByName(once)
