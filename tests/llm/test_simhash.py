"""Fingerprints and components against brute force, with overfull buckets."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lociframe.llm import simhash as S
from lociframe.llm.simhash import components, keep_one_of_each, links, near_duplicates, simhash


def literal(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    for text in ("", "  \n", "one", "One two", "a b c", "a b c d e f a b c", "É é A\x0bB\x0cC\x1cD", "x " * 40_000, "word " * 70_000 + "end"):
        if len(text) < 1000:
            assert simhash(text, 3) == literal(text), text
    rng = random.Random(2)
    long = " ".join(str(rng.randrange(500)) for _ in range(70_000))   # more than two blocks
    assert simhash(long, 3) == literal(long)


def near(prints, d):
    arr = np.array(prints, np.uint64)
    return [(prints[i], prints[int(j)]) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= d) if j > i]


@pytest.mark.parametrize(("distance", "segments", "limit"), [(2, 2, 64), (2, 2, 3), (3, 2, 4), (1, 3, 2), (4, 4, 5), (0, 2, 2)])
def test_links_connect_exactly_the_near_ones(spark, distance, segments, limit):
    rng = random.Random(distance * 10 + segments)
    prints = set()
    for _ in range(6):   # clusters of which many share a segment, so buckets overflow
        centre = rng.getrandbits(64)
        for _ in range(40):
            v = centre
            for _ in range(rng.randrange(6)):
                v ^= 1 << rng.choice([rng.randrange(64), rng.randrange(8), 60])
            prints.add(v)
    prints |= {0, (1 << 64) - 1, 1 << 63}
    prints = sorted(prints)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = components(links(df, distance, segments, limit)).collect()
    got = {p: signed(p) for p in prints}
    got = {signed(p): signed(p) for p in prints} | {r.node: r.root for r in found}
    want = groups([(signed(a), signed(b)) for a, b in near(prints, distance)], [signed(p) for p in prints])
    same = lambda g: sorted(sorted(n for n in g if g[n] == r) for r in set(g.values()))
    assert same(got) == same(want)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (7, 6)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_brute_force(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: literal(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    pairs = near(sorted(set(docs.values())), 2)
    of_print = groups(pairs, sorted(set(docs.values())))
    first = {}
    for d, p in docs.items():
        first[of_print[p]] = min(d, first.get(of_print[p], d))
    got = E.queries()["op2_simhash"](spark, sf).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(d, f"{p:016x}", first[of_print[p]]) for d, p in docs.items()}
    assert len(got) == len(docs)


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(3, "a b c d", 1), (3, "a b c d", 1), (2, "A b  c\nd", 2), (None, "a b c d", 3), (9, None, 4), (8, "", 5), (None, "other words here", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumn("root", F.lit(1)).withColumn("k", F.lit(1)).withColumn("a.b", F.lit(1))
    got = near_duplicates(df).collect()
    assert len(got) == 7
    by = {(r.doc_id, r.component_id) for r in got}
    assert by == {(3, 2), (2, 2), (None, 2), (9, 8), (8, 8), (None, None)}
    assert {r.fingerprint for r in got if r.doc_id in (8, 9)} == {"0" * 16}
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.fp) for r in kept.collect()) == [(0, 6), (2, 2), (8, 5)]
    again = keep_one_of_each(spark.createDataFrame([(1, "x y z w", "p"), (1, "x y z w", "p")], "doc_id long, text string, kept_key string"))
    assert again.count() == 1
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one_of_each(df.limit(0)).count() == 0


def test_one_row_of_each_component_whatever_the_ids(spark):
    schema = "doc_id long, text string, n int"
    keep = lambda rows: sorted(r.n for r in keep_one_of_each(spark.createDataFrame(rows, schema)).collect())
    assert len(keep([(None, "Some Words here", 1), (None, "some words HERE", 2)])) == 1
    assert len(keep([(5, "Some Words here", 1), (5, "some words HERE", 2)])) == 1
    assert keep([(None, "Some Words here", 1), (5, "some words HERE", 2), (7, "some words here", 3), (None, "far away from it", 4)]) == [2, 4]
    assert len(keep([(None, None, 1), (None, "", 2), (None, " ", 3)])) == 1


def test_stars_take_no_round(spark, monkeypatch):
    kept, stored = [], S.stored
    monkeypatch.setattr(S, "stored", lambda df, purpose: kept.append(purpose) or stored(df, purpose))
    for edges, rounds in (([(1, 2), (3, 1), (7, 9), (9, 7), (5, 5)], 0), ([(1, 2), (2, 3), (9, 8)], 1)):
        kept.clear()
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == ({1: 1, 2: 1, 3: 1, 7: 7, 9: 7} if not rounds else {1: 1, 2: 1, 3: 1, 8: 8, 9: 8})
        assert kept == ["edges"] * (1 + rounds)
