"""Exact top-k inner products by no-random-access aggregation (NRA).

Vectors are packed into blocks.  A block has one list per component, sorted by
value.  For a block of queries the lists are read in step, from both ends (the
best entries stand at one end for positive query components and at the other
for negative ones).  What has been read of a candidate is its known score; each
unread component lies between the two read fronts of its list, which bounds the
score from below and above.  A query stops reading when nearly all candidates
cannot qualify, their upper bound being under the k-th best lower bound; the
scores of the few that still can are then resolved.  Bounds keep ties: a
candidate that can only draw level is not dropped.

Query blocks meet candidate blocks by an equi-join on block numbers (a stated
query set against all rows, in blocks); each pair returns at most k rows a
query, and the k best of those are the answer.

Arithmetic is exact: single or double precision only where all sums stay
within their integers, else 64-bit or unlimited integers; a score beyond a long
counts as the nearest long.

Defined results: vectors that are null or hold null or non-finite components take
no part, nor do rows with a null id; a query meets candidates of its own length
only; a query's own row is no candidate, but another row that repeats its id is;
equal scores rank by smaller id, then by row; an empty table gives an empty
result.  Only the named columns are read, so further columns never clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.common import stored

BLOCK = 4096             # vectors of a candidate block
QUERIES = 4096           # vectors of a query block
BATCH = 256              # queries whose bounds are held at a time
ROUNDS = 12              # a list is read in so many steps from either end
FIRST = 5                # bounds are looked at from this step on
RESOLVE = 16             # candidates to resolve: k times this, or a 16th of the block

PACKED = "block long, dim int, n int, ids binary, rows binary, values binary, lists binary"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]


def vectors_of(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (positions in the column, matrix) of the vectors without nulls."""
    offsets = column.offsets.to_numpy()
    length = np.diff(offsets)
    values = pc.fill_null(column.values, float("nan")).to_numpy(zero_copy_only=False)
    there = ~column.is_null().to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(length[there]):
        at = np.flatnonzero(there & (length == n))
        out[int(n)] = at, values[offsets[at][:, None] + np.arange(n)] if n else np.zeros((len(at), 0))
    return out


def pack(vectors: DataFrame, size: int, scale: float, with_lists: bool) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length, cut where the rows are
    read: (block, dim, n, ids, rows, values, lists)."""
    def run(batches):
        from pyspark import TaskContext
        number = (TaskContext.get().partitionId() + 1) << 32
        held: dict[int, list] = {}

        def packed(dim: int) -> pa.RecordBatch:
            nonlocal number
            ids, rows, values = (np.concatenate(x) for x in zip(*held.pop(dim)))
            out = []
            for a in range(0, len(ids), size):
                v = values[a:a + size]
                lists = np.argsort(v, axis=0, kind="stable").T.astype("<u4").tobytes() if with_lists else b""
                out.append((number, dim, len(v), ids[a:a + size].astype("<i8").tobytes(), rows[a:a + size].astype("<i8").tobytes(),
                            v.astype("<f8").tobytes(), lists))
                number += 1
            kinds = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=_NAMES)

        for b in batches:
            ids, rows = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for dim, (at, matrix) in vectors_of(b.column(2)).items():
                with np.errstate(all="ignore"):
                    whole = np.floor(scale * matrix)
                good = np.isfinite(whole).all(axis=1)
                if good.any():
                    held.setdefault(dim, []).append((ids[at[good]], rows[at[good]], whole[good]))
                    if sum(len(x[0]) for x in held[dim]) >= size:
                        yield packed(dim)
        for dim in list(held):
            yield packed(dim)

    return vectors.select("id", "row", "vector").mapInArrow(run, PACKED)


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the narrowest type whose inner products are exact."""
    bound = (float(np.abs(a).max(initial=0)) + 1) * (float(np.abs(b).max(initial=0)) + 1) * (a.shape[1] + 1) * 2
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        return a.astype(kind), b.astype(kind)
    if bound < 1 << 62:
        return a.astype(np.int64), b.astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    return (as_int(a) if a.size else a.astype(object)), (as_int(b) if b.size else b.astype(object))


def nra(queries: np.ndarray, own: list, values: np.ndarray, lists: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """For each query (row of ``queries``): positions and scores of the k best
    rows of ``values``; ``own[i]``: the position to leave out or None.
    lists[j]: the positions in ascending order of component j."""
    n, dim = values.shape
    queries, values = exact(queries, values)
    seen = np.zeros((n, dim), bool)
    active, result = np.arange(len(queries)), [None] * len(queries)
    few = max(RESOLVE * k, n // 16)
    step = max(1, -(-n // (2 * ROUNDS)))
    columns = np.arange(dim)[:, None]
    ordered = np.take_along_axis(values, lists.T.astype(np.int64), axis=0) if dim else values
    depth = 0
    while len(active):
        # read the next entries of every list, from both ends
        to = min(n, depth + step)
        for part in (lists[:, depth:to], lists[:, max(0, n - to):n - depth]):
            seen[part, np.broadcast_to(columns, part.shape)] = True
        depth = to
        whole = 2 * depth >= n
        if not whole and depth < FIRST * step:
            continue
        low, high = (None, None) if whole else (ordered[depth - 1], ordered[n - depth])
        unread = (~seen).astype(values.dtype) if not whole else None
        known = values if whole else np.where(seen, values, values.dtype.type(0) if values.dtype != object else 0)
        stay = []
        for a in range(0, len(active), BATCH):
            some = active[a:a + BATCH]
            q = queries[some]
            lower = q @ known.T
            upper = lower
            if not whole:
                ends = q * low, q * high
                upper = lower + np.maximum(*ends) @ unread.T
                lower = lower + np.minimum(*ends) @ unread.T
            for i, number in enumerate(some):
                left = np.arange(n) != own[number] if own[number] is not None else np.ones(n, bool)
                best = lower[i][left]
                if len(best) > k:
                    limit = np.sort(best)[-k] if best.dtype == object else np.partition(best, len(best) - k)[len(best) - k]
                    left &= (upper[i] >= limit).astype(bool)
                if not whole and left.sum() > few:
                    stay.append(number)
                    continue
                # resolve the final scores of those that can still qualify
                at = np.flatnonzero(left)
                score = lower[i][at] if whole else values[at] @ queries[number]
                order = np.lexsort((rows[at], ids[at], [-int(s) for s in score] if score.dtype == object else -score))[:k]
                result[number] = at[order], score[order]
        active = np.array(stay, np.int64)
    return result


OUT = "query_id long, query_row long, vec_id long, vec_row long, score long"


def top_k(vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score) over a frame (id, vector): the ``k`` best
    rows for each row that ``is_query`` (over ``id``) chooses."""
    rows = vectors.select(F.col("id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                          F.col("vector").cast("array<double>").alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL")
    candidates = stored(pack(rows, BLOCK, scale, True), "candidate-blocks")
    queries = stored(pack(rows.where(is_query), QUERIES, scale, False), "query-blocks")
    numbers = queries.groupBy(F.col("dim").alias("q_dim")).agg(F.collect_list("block").alias("numbers"))
    pairs = (candidates.select("block", "dim").join(numbers, F.col("dim") == F.col("q_dim"))
             .select("block", F.explode("numbers").alias("q_block")))
    q = queries.select(F.col("block").alias("q_block"), *[F.col(c).alias(f"q_{c}") for c in ("n", "ids", "rows", "values")])
    met = pairs.join(q, "q_block").join(candidates, "block")

    def run(batches):
        for b in batches:
            for pair in b.to_pylist():
                n, dim, m = pair["n"], pair["dim"], pair["q_n"]
                ids, at = np.frombuffer(pair["ids"], "<i8"), np.frombuffer(pair["rows"], "<i8")
                q_ids, q_at = np.frombuffer(pair["q_ids"], "<i8"), np.frombuffer(pair["q_rows"], "<i8")
                values = np.frombuffer(pair["values"], "<f8").reshape(n, dim)
                asked = np.frombuffer(pair["q_values"], "<f8").reshape(m, dim)
                place = {int(r): i for i, r in enumerate(at)}
                found = nra(asked, [place.get(int(r)) for r in q_at], values, np.frombuffer(pair["lists"], "<u4").reshape(dim, n), ids, at, k)
                size = [len(p) for p, _ in found]
                spots = np.concatenate([p for p, _ in found]).astype(np.int64)
                limit = (1 << 63) - 1
                scores = [max(-limit - 1, min(limit, int(s))) for _, ss in found for s in ss]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, size)), pa.array(np.repeat(q_at, size)), pa.array(ids[spots]), pa.array(at[spots]),
                     pa.array(scores, pa.int64())], names=[c.split()[0] for c in OUT.split(", ")])

    best = met.select("n", "dim", "ids", "rows", "values", "lists", "q_n", "q_ids", "q_rows", "q_values").mapInArrow(run, OUT)
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
