"""NRA against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import lociframe.llm.topk as T
from lociframe.llm.topk import top_k


def brute(rows, every, k):
    good = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for m, j, w in good if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, every, k, parts=3):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "id long, vector array<double>, score string").repartition(parts)
    # repartition() deals rows anew: only (id, vector) identify a row here
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, F.col("id") % every == 0, k).collect())


def test_block_scores_equal_brute_force():
    rng = np.random.default_rng(1)
    for n, dim, k in ((1, 3, 5), (4, 2, 5), (300, 8, 5), (2000, 16, 3), (50, 1, 5), (40, 0, 2)):
        values = np.floor(rng.normal(0, 30, (n, dim)))
        values[: n // 3] = values[0] if n else 0     # many ties
        ids = rng.permutation(n)
        q = values[:min(n, 20)]
        lists = np.argsort(values, axis=0, kind="stable").T.astype("<u4")
        found = T.nra(q, [*range(len(q))], values, lists, ids, np.arange(n), k)
        for i, (at, score) in enumerate(found):
            want = sorted((-int(values[j] @ q[i]), ids[j], j) for j in range(n) if j != i)[:k]
            assert [(-int(s), ids[a], a) for a, s in zip(at, score)] == want


def test_stops_before_the_lists_end(monkeypatch):
    rng = np.random.default_rng(2)
    values = np.floor(rng.normal(0, 30, (4000, 16)))
    resolved = []
    real = np.lexsort
    monkeypatch.setattr(T.np, "lexsort", lambda keys: resolved.append(len(keys[0])) or real(keys))
    T.nra(values[:5], [*range(5)], values, np.argsort(values, axis=0).T.astype("<u4"), np.arange(4000), np.arange(4000), 5)
    assert len(resolved) == 5 and max(resolved) <= 4000 // 16


def test_random_tables(spark):
    rng = random.Random(4)
    rows = [(n if rng.random() > .05 else None,
             None if rng.random() < .05 else [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1), 0.5]) for _ in range(rng.choice([6, 6, 6, 2, 0]))])
            for n in range(400)]
    for i in range(0, 400, 37):
        if rows[i][1]:
            rows[i][1][0] = rng.choice([None, math.nan, math.inf])
    rows += [(100 + i, [0.25] * 6) for i in range(40)]      # ties, and repeated ids
    want = brute(rows, 10, 5)
    assert run(spark, rows, 10, 5) == want and want


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**e + i, -(2.0**e), i * 1.5]) for i in range(30) for e in (20,)] + [(50, [1e7, 3.0, 0.0])]
    got = {(q, r): (v, s) for q, r, v, s in run(spark, rows, 10, 3)}
    want = {(q, r): (v, s) for q, r, v, s in brute(rows, 10, 3)}
    assert got == want and max(s for _, s in want.values()) > 2**53
    beyond = run(spark, [(0, [1e30, 1.0]), (1, [1e30, 2.0])], 10, 3)
    assert beyond == [(0, 1, 1, 2**63 - 1)]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, vector array<float>")
    assert top_k(df, F.col("id") % 2 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "id long, vector array<float>")
    assert top_k(one, F.col("id") % 2 == 0).count() == 0
