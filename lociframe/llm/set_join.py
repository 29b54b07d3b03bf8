"""Jaccard self-join of n-gram sets by a partitioned universe and pigeonholes.

1. Rows with equal sets collapse into one *node*, so copies are joined once.
2. Sizes fall into bands whose ends lie one similarity apart: the partners of a
   set lie in its own band or a neighbouring one.  A band is a *space* for the
   pairs whose smaller set lies in it; two linked sets of a space differ in at
   most ``h`` tokens.
3. The token universe is hashed into ``h + 1`` segments.  Units are dealt to a
   probing set's segments, ``h + 1`` in all: none (the segment is not looked
   up), one (equal segments are found) or two (segments that differ in one token
   are found as well).  If a pair is linked, some segment differs in fewer
   tokens than it has units, so that the pair is found there.
4. The index holds every segment, and for a few *reserve* segments the
   neighbourhood with one token deleted too.  Allocation is by cost: from a
   histogram of all index keys, a probing set gives the dearest segments (empty
   ones first) no unit and the cheapest reserves two.
5. Rows that share a key are candidates.  A parity sketch (bit i is the parity of
   the tokens hashed to i) drops most of the false ones: two sets differ in at
   least as many tokens as their sketches in bits.  The sets themselves decide.
   Each key's members are first compared with the smallest of them, then, in larger
   keys that still hold several components, with one that a hash picks for the
   key: both are linear, and leave a group of near copies in one component.  Only
   members of different components are then paired, so such a group is never
   expanded.  Of keys with more than ``FEW`` members
   the sketches meet in blocks, and only pairs that they leave possible become
   rows.  No link between two components is lost.

Tokens are 64-bit hashes of the n-grams (all sums of hashes below are only used
to find candidates): two different n-grams of a pair of documents count as one
with a probability of about 2**-64.

Defined results: a null or wordless text has no shingles, is linked with nothing
and is its own component; repeated rows and equal sets belong to one component;
rows with a null id are returned and lend no id, so a component without any id
has a null ``component_id``; an empty table gives an empty result.  Only
``doc_id`` and ``text`` are read, so further columns never clash.
"""

from __future__ import annotations

import struct
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.common import PART, mix, parts, small, stored, texts
from lociframe.llm.simhash import components

BUCKETS = 1 << 18         # of the cost histogram, whatever the input
SETS = 256                # sets worked on at a time
FEW = 16                  # members of a key that are paired as rows
BLOCK = 256               # members of larger keys whose sketches meet at a time
SEEN = 1_000_000          # digests that a task remembers

_U = np.uint64
_ODD = [_U(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


#: a random 64-bit word for every place in a word and every byte there
TABLE = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 1 << 16, dtype=_U) * _U(2) + _U(1)
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the words (runs of bytes that are not white space): the
    sum of table words for its bytes by their place in it, mixed with its length."""
    a = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(~WHITE[a])
    if not len(at):
        return np.zeros(0, _U), at
    starts = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    size = np.diff(starts, append=len(at))
    place = np.arange(len(at)) - np.repeat(starts, size)
    value = TABLE[((place & 255) << 8) + a[at]]
    if size.max() > 256:
        value *= (2 * (place >> 8) + 1).astype(_U)
    return mix(np.add.reduceat(value, starts) + size.astype(_U) * _ODD[3]), at[starts]


def gram_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    n = len(h) - width + 1
    total = np.full(n, _U(width), _U)
    for i in range(width):
        total += h[i:i + n] * (_ODD[i % 4] + _U(2 * (i // 4)))
    return mix(total)


def sets_of(many: list[str], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, ends): the sorted distinct n-gram hashes of each text, one after the
    other.  Texts are joined to work on many at a time; a very long one is cut
    into parts, so that only its hashes are held as a whole."""
    found: list[np.ndarray] = []
    group: list[bytes] = []
    room = 0

    def flush():
        nonlocal room
        if group:
            h, at = word_hashes(b" ".join(group))
            begins = np.cumsum([0] + [len(t) + 1 for t in group])
            split = np.searchsorted(at, begins).tolist()
            grams = gram_hashes(h, shingle) if len(h) >= shingle else np.zeros(0, _U)
            found.extend(distinct(h[i:j], grams[i:j - shingle + 1] if j - i >= shingle else None) for i, j in zip(split, split[1:]))
            group.clear()
            room = 0

    def distinct(h, grams):
        if grams is None:        # fewer words: the whole sequence
            return gram_hashes(h, len(h)) if len(h) else h
        grams.sort()             # its places in the joined array are its own
        return grams[np.concatenate([_TRUE, grams[1:] != grams[:-1]])]

    for t in many:
        data = t.encode("utf-8", "surrogatepass").lower()
        if len(data) > PART:
            flush()
            h = np.concatenate([word_hashes(x)[0] for x in parts(data)])
            found.append(distinct(h, gram_hashes(h, shingle) if len(h) >= shingle else None))
            continue
        if room + len(data) > PART:
            flush()
        group.append(data)
        room += len(data) + 1
    flush()
    return np.concatenate([np.zeros(0, _U), *found]), np.cumsum([0] + [len(x) for x in found])


_TRUE = np.ones(1, bool)


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens by their lowest bits; a power of two of them, two to
    four times as many as tokens, so that few tokens share a bit."""
    bits = 64 << (len(tokens) // 32).bit_length()
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


def sketches_differ(a: bytes, b: bytes) -> int:
    """Differing bits; the longer sketch is folded to the shorter one's length."""
    if len(a) < len(b):
        a, b = b, a
    x = np.bitwise_xor.reduce(np.frombuffer(a, "<u8").reshape(-1, len(b) // 8), axis=0) ^ np.frombuffer(b, "<u8")
    return int(np.bitwise_count(x).sum())


class Spaces:
    """Bands of sizes, and for each the number of segments and of reserves, for a
    similarity of at least ``percent`` per cent."""

    def __init__(self, percent: int, slack: int = 25):
        self.percent, self.slack, self.ends = percent, slack, [1]

    def band(self, n: int) -> int:
        while self.ends[-1] <= n:
            self.ends.append(self.ends[-1] * 100 // self.percent + 1)
        return bisect_right(self.ends, n) - 1

    def segments(self, band: int) -> tuple[int, int]:
        """(segments, reserves) of a space; no segments where only equal sets link."""
        while len(self.ends) < band + 2:
            self.band(self.ends[-1])
        x = self.ends[band + 1] - 1
        h = (100 - self.percent) * (x + x * 100 // self.percent) // (100 + self.percent)
        return (h + 1, min(h + 1, 3 + (h + 1) // self.slack)) if h else (0, 0)


class Keys:
    """Keys of the segments of sets.  Tokens are sorted and segments are ranges of
    hash values, so a segment is a range of a set's tokens; its value is their
    sum, from which a token can be taken away again."""

    def __init__(self, percent: int):
        self.spaces, self.bounds, self.marks = Spaces(percent), {}, {}

    def starts(self, space: int) -> np.ndarray:
        """The smallest token of each segment of a space, and an end."""
        if space not in self.bounds:
            m = self.spaces.segments(space)[0]
            low = -((-np.arange(m, dtype=np.int64) << 32) // m)
            self.bounds[space] = low.astype(_U) << _U(32)
        return self.bounds[space]

    def labels(self, space: int, deleted: bool = False) -> np.ndarray:
        if (space, deleted) not in self.marks:
            m = self.spaces.segments(space)[0]
            label = (_U(space) << _U(33)) + (np.arange(m, dtype=_U) << _U(1)) + _U(deleted)
            self.marks[space, deleted] = mix(label * _ODD[0] + _ODD[2])
        return self.marks[space, deleted]

    def segments(self, tokens: np.ndarray, ends: np.ndarray, below: bool):
        """For each set its own space (and the one ``below``): (set, space, cut)
        with the segments' places among all tokens, and the values and keys of
        all these segments, one after the other."""
        cuts = []
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            own = self.spaces.band(b - a) if b > a else -1
            for space in (own, own - 1) if below else (own,):
                if space >= 0 and self.spaces.segments(space)[0]:
                    cut = np.append(np.searchsorted(tokens[a:b], self.starts(space)), b - a)
                    cut += a
                    cuts.append((i, space, cut))
        if not cuts:
            return cuts, np.zeros(0, _U), np.zeros(0, _U)
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(tokens, dtype=_U)])
        values = np.concatenate([np.diff(sums[c]) for _, _, c in cuts])
        return cuts, values, mix(values + np.concatenate([self.labels(s) for _, s, _ in cuts]))

    def deletions(self, tokens: np.ndarray, which: np.ndarray, cut: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment, value) of the segments ``which`` without one token each."""
        begin, size = cut[which], cut[which + 1] - cut[which]
        of = np.repeat(which, size)
        place = np.arange(len(of)) + np.repeat(begin - (np.cumsum(size) - size), size)
        return of, values[of] - tokens[place]


def allocate(cost: np.ndarray, dear: np.ndarray, size: np.ndarray, reserves: int) -> np.ndarray:
    """Units of each segment, as many in all as there are segments.  A ``dear``
    segment hands its unit to the cheapest reserve that has one unit still, if
    that costs less (its own cost and the rows of its neighbourhood)."""
    units = np.ones(len(cost), np.int8)
    price = (np.maximum(cost[:reserves], 0) + size[:reserves] + 2)
    price[size[:reserves] < 2] = np.inf      # without its one token it is an empty segment
    price = price.tolist()
    free = sorted(range(reserves), key=price.__getitem__)
    drop = np.flatnonzero(dear)
    for i in drop[np.argsort(-cost[drop], kind="stable")].tolist():
        j = next((f for f in free if f != i and units[f] == 1), None)
        if j is not None and units[i] == 1 and price[j] < cost[i]:
            units[i], units[j] = 0, 2
            free.remove(j)
    return units


_DIGESTS = [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
            ("sketch", pa.binary()), ("hist", pa.list_(pa.int64()))]


def digest_rows(batches, shingle: int, percent: int):
    """The rows of ``digests`` from batches (doc_id, text, text_key) of one task.  ``SETS``
    texts at a time become strings, tokens and keys: a task holds no batch of them."""
    names, kinds = zip(*_DIGESTS)
    keys, seen, hist = Keys(percent), set(), np.zeros(BUCKETS, np.int64)
    for b in batches:
        for part in (b.slice(at, SETS) for at in range(0, b.num_rows, SETS)):
            out, new = [], []
            tokens, ends = sets_of(texts(part.column(1)), shingle)
            for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
                d = xxhash.xxh3_128_digest(tokens[i:j].data)
                out.append((j - i, *struct.unpack("<qq", d), sketch(tokens[i:j])))
                if d not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(d)
                    new.append(tokens[i:j])
            kept = np.cumsum([0] + [len(x) for x in new])
            np.add.at(hist, bucket_of(keys.segments(np.concatenate([np.zeros(0, _U), *new]), kept, below=False)[2]), 1)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *(pa.array(x, k) for x, k in zip(zip(*out), kinds[2:6])),
                                              pa.nulls(len(out), kinds[6])], names=names)
    if hist.any():
        yield pa.RecordBatch.from_arrays([pa.nulls(1, k) for k in kinds[:6]] + [pa.array([hist], kinds[6])], names=names)


def digests(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n, d1, d2, sketch) of every row, d1 and d2 a digest of its
    set; and from each task one row whose ``hist`` counts the index keys of its sets
    by bucket (a set that it saw before counts once)."""
    def run(batches):
        yield from digest_rows(batches, shingle, percent)

    return _narrow(docs).mapInArrow(run, "doc_id long, text_key long, n long, d1 long, d2 long, sketch binary, hist array<long>")


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> _U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_key"))


def _of_nodes(docs: DataFrame, nodes: DataFrame, n_nodes: int | None = None) -> DataFrame:
    """(node, text) of the rows that stand for the (stored) nodes."""
    d, nodes = _narrow(docs), small(nodes.select("node", "rep_id", "rep_key"), n_nodes)
    return (d.join(nodes, d["doc_id"].eqNullSafe(nodes["rep_id"]) & d["text_key"].eqNullSafe(nodes["rep_key"]))
            .select("node", "text"))


def signatures(node_texts: DataFrame, shingle: int, percent: int, hist: np.ndarray) -> DataFrame:
    """(key, node, n, role): role 1 for index rows, 2 for probes, 3 for both."""
    counts = hist.astype("<i8").tobytes()

    def run(batches):
        keys, cost_of = Keys(percent), np.frombuffer(counts, "<i8")
        for b in batches:
            for at in range(0, b.num_rows, SETS):
                part = b.slice(at, SETS)
                tokens, ends = sets_of(texts(part.column(1)), shingle)
                key, of, role = set_rows(tokens, ends, keys, cost_of)
                node, n = part.column(0).to_numpy(zero_copy_only=False)[of], np.diff(ends)[of]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node), pa.array(n), pa.array(role)],
                                                 names=["key", "node", "n", "role"])

    return node_texts.mapInArrow(run, "key long, node long, n long, role byte")


def set_rows(tokens: np.ndarray, ends: np.ndarray, keys: Keys, cost_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, set, role) of many sets: index rows and probes in the space of a
    set's band, probes in the space below."""
    cuts, values, full = keys.segments(tokens, ends, below=True)
    mean = float(cost_of.mean())
    cost = cost_of[bucket_of(full)] - mean
    if cuts:
        cost[np.concatenate([c[1:] == c[:-1] for _, _, c in cuts])] = np.inf   # empty segments meet whatever is empty there
    dear = cost > 8 + 6 * mean ** 0.5
    role = np.full(len(full), 2, np.int8)
    sets, more = [], []          # ``more``: (values, labels, set, role) beyond the full segments
    before, at = -1, 0
    for i, space, cut in cuts:
        m, reserves = keys.spaces.segments(space)
        here = slice(at, at + m)
        sets.append((i, m))
        own = i != before
        units = allocate(cost[here], dear[here], np.diff(cut), reserves) if dear[here].any() else None
        if own:
            role[here] = 3
            of, value = keys.deletions(tokens, np.arange(reserves), cut, values[here])
            more.append((value, keys.labels(space, True)[of], i, 1))
        if units is not None:
            role[here][units == 0] = 1 if own else 0
            two = np.flatnonzero(units == 2)
            if len(two):
                of, value = keys.deletions(tokens, two, cut, values[here])
                more.append((value, keys.labels(space)[of], i, 2))
                more.append((values[here][two], keys.labels(space, True)[two], i, 2))
        before, at = i, at + m
    of = np.repeat(*(np.array(x, np.int64) for x in zip(*sets))) if sets else np.zeros(0, np.int64)
    key = full
    if more:
        key = np.concatenate([full, mix(np.concatenate([v for v, _, _, _ in more]) + np.concatenate([x for _, x, _, _ in more]))])
        size = [len(v) for v, _, _, _ in more]
        of = np.concatenate([of, np.repeat([i for _, _, i, _ in more], size)])
        role = np.concatenate([role, np.repeat(np.array([r for _, _, _, r in more], np.int8), size)])
    used = role > 0
    return key[used], of[used], role[used]


def token_sets(node_texts: DataFrame, shingle: int) -> DataFrame:
    """(node, tokens): the whole sets, sorted."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, SETS):
                part = b.slice(at, SETS)
                tokens, ends = sets_of(texts(part.column(1)), shingle)
                sets = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(tokens.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["node", "tokens"])

    return node_texts.mapInArrow(run, "node long, tokens array<long>")


def possible(batches, percent: int):
    """The pairs (a, b) of the batches (a, b, na, nb, sa, sb) that their sketches leave
    possible.  Sketches become Python objects some at a time: a task holds no
    batch of them beside the batch itself."""
    for b in batches:
        for part in (b.slice(at, SETS) for at in range(0, b.num_rows, SETS)):
            size = (part.column("na").to_numpy() + part.column("nb").to_numpy())
            most = size - 2 * -(-percent * size // (100 + percent))
            stay = [sketches_differ(x, y) <= m for x, y, m in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist(), most.tolist())]
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(stay, pa.bool_()))


def close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` that their sketches leave possible."""
    def side(c: str) -> DataFrame:
        return nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))

    def run(batches):
        yield from possible(batches, percent)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def folded(many: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to the shortest one's length."""
    words = min(map(len, many)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, "<u8").reshape(-1, words), axis=0) for x in many])


def close_in_blocks(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Possible pairs (a, b) among the members (key, node, n, role, root, c) of large
    keys: of different roots, a probe and a smaller index row, and not ruled out by
    their sketches.  A key of c members makes c / ``BLOCK`` blocks, and every two of
    them meet in a group of their own."""
    part = members.join(nodes.select(F.col("node").alias("s_node"), "sketch"), F.col("node") == F.col("s_node")).drop("s_node")
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    part = part.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    part = part.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = (part.groupBy("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
           .agg(F.collect_list(F.struct("node", "n", "role", "root", "block", "sketch")).alias("m")).select("i", "j", "m"))

    def run(batches):
        for b in batches:
            # a group at a time, its numbers read in place: a batch holds many groups
            for at, (i, j) in enumerate(zip(b.column("i").to_pylist(), b.column("j").to_pylist())):
                m = b.column("m").slice(at, 1).flatten()
                node, n, role, root, block = (m.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("node", "n", "role", "root", "block"))
                bits = folded(m.field("sketch").to_pylist())
                # a block meets itself, or the other one
                index = {k: np.flatnonzero((role & 1 > 0) & ((block != k) | (i == j))) for k in {i, j}}
                a, z = [], []
                for x in np.flatnonzero(role & 2).tolist():
                    y = index[int(block[x])]
                    y = y[(root[y] != root[x]) & ((n[y] < n[x]) | (n[y] == n[x]) & (node[y] < node[x])) & (100 * n[y] >= percent * n[x])]
                    size = n[y] + n[x]
                    near = np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64) <= size - 2 * -(-percent * size // (100 + percent))
                    a += np.minimum(node[y[near]], node[x]).tolist()
                    z += np.maximum(node[y[near]], node[x]).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

    return met.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame | None:
    """The (a, b) of (stored) ``pairs`` whose sets are similar enough, counted exactly;
    None if there are no pairs."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("w")).distinct()
    there = stored(nodes.join(wanted, F.col("node") == F.col("w"), "left_semi").select("node", "rep_id", "rep_key"), "wanted-nodes")
    n_nodes = there.count()
    if not n_nodes:
        return None
    sets = stored(token_sets(_of_nodes(docs, there, n_nodes), shingle), "token-sets")

    def side(c: str) -> DataFrame:
        return sets.select(F.col("node").alias(c), F.col("tokens").alias(f"t{c}"))

    both = F.size(F.array_intersect("ta", "tb")).cast("long")
    sizes = (F.size("ta") + F.size("tb")).cast("long")
    return stored(pairs.join(side("a"), "a").join(side("b"), "b")
                  .where(both * (100 + percent) >= sizes * percent).select("a", "b"), "links")


def similar_enough(n: str, other: str, percent: int):
    return F.least(n, other) * 100 >= F.greatest(n, other) * percent


def open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """The (key, node, n, role) of ``members`` with their root in the components of
    ``found``, of keys that hold several; c is the number of the key's members."""
    roots = components(found).withColumnsRenamed({"node": "r_node", "root": "r_root"})
    w = Window.partitionBy("key")
    out = (members.join(roots, F.col("node") == F.col("r_node"), "left")
           .select("key", "node", "n", "role", F.coalesce("r_root", "node").alias("root"))
           .withColumns({"low": F.min("root").over(w), "high": F.max("root").over(w), "c": F.count("*").over(w)}))
    return stored(out.where("low < high").drop("low", "high").distinct(), "open-keys")


def links(docs: DataFrame, nodes: DataFrame, hist: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) among the nodes; they connect exactly what all links of
    similar sets connect."""
    rows = signatures(_of_nodes(docs, nodes), shingle, percent, hist)
    w = Window.partitionBy("key")

    def checked(pairs: DataFrame) -> DataFrame | None:
        return verified(stored(pairs, "close-pairs"), docs, nodes, shingle, percent)

    # every member of a key with the smallest one
    first = F.min(F.struct("node", "n")).over(w)
    shared = stored(rows.withColumns({"first": first, "last": F.max("node").over(w)})
                    .where(F.col("first.node") < F.col("last")).drop("last"), "shared-keys")
    star = (shared.where(F.col("node") != F.col("first.node")).where(similar_enough("n", "first.n", percent))
            .select(F.col("first.node").alias("a"), F.col("node").alias("b")).distinct())
    near = checked(close(star, nodes, percent))
    if near is None:
        near = docs.sparkSession.createDataFrame([], "a long, b long")

    # in large keys where components differ, with one that depends on the key
    member = open_members(shared, near)
    centre = F.min(F.struct(F.xxhash64("key", "node").alias("h"), "node", "n", "root")).over(w)
    star = (member.where(F.col("c") > FEW).withColumn("x", centre).where((F.col("root") != F.col("x.root")) & similar_enough("n", "x.n", percent))
            .select(F.least("node", "x.node").alias("a"), F.greatest("node", "x.node").alias("b")).distinct())
    more = checked(close(star, nodes, percent))
    if more is not None:         # else the components are as they were
        near = near.unionByName(more)
        member = open_members(member, near)

    # all others of different components, probes with smaller index rows
    small_key = member.where(F.col("c") <= FEW)
    index = small_key.where(F.col("role").bitwiseAND(F.lit(1)) != 0).select("key", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    probe = small_key.where(F.col("role").bitwiseAND(F.lit(2)) != 0).select("key", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    rest = (index.join(probe, "key").where((F.col("ra") != F.col("rb")) & (F.struct("na", "a") < F.struct("nb", "b")))
            .where(similar_enough("na", "nb", percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rest = checked(close(rest, nodes, percent).unionByName(close_in_blocks(member.where(F.col("c") > FEW), nodes, percent)).distinct())
    return near if rest is None else near.unionByName(rest)


def similar_documents(docs: DataFrame, shingle: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    found = stored(digests(docs, shingle, percent), "set-digests")
    rows = found.where("n is not null").drop("hist")
    counted = (found.where("hist is not null").select(F.posexplode("hist").alias("bucket", "c")).where("c > 0")
               .groupBy("bucket").agg(F.sum("c").alias("c")).toPandas())
    hist = np.zeros(BUCKETS, np.int64)
    hist[counted["bucket"].to_numpy(np.int64)] = counted["c"].to_numpy(np.int64)

    nodes = stored(rows.where("n > 0").groupBy("d1", "d2", "n").agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("first_id"),
                                                              F.first("sketch").alias("sketch"))
                   .select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "n", "sketch", "first_id",
                           F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_key").alias("rep_key")), "nodes")
    roots = stored(components(links(docs, nodes, hist, shingle, percent)), "roots").withColumnsRenamed({"node": "r_node"})
    placed = nodes.join(roots, F.col("node") == F.col("r_node"), "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy(F.col("root").alias("c_root")).agg(F.min("first_id").alias("smallest"))
    of = placed.join(smallest, F.col("root") == F.col("c_root")).select(F.col("d1").alias("x1"), F.col("d2").alias("x2"), "smallest")
    return (rows.select("doc_id", "n", "d1", "d2").join(of, (F.col("d1") == F.col("x1")) & (F.col("d2") == F.col("x2")), "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id")))
