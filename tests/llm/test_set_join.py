"""The set join against brute force, near the threshold and with hot segments."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import set_join as J


def literal(text, shingle=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < shingle else [tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)])


def classes(rows, percent, shingle=4):
    sets = [literal(t, shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    n_links = 0
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                n_links += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    smallest = {}
    for k, (d, _) in enumerate(rows):
        smallest.setdefault(find(k), []).append(d)
    return [(d, len(sets[k]), min((x for x in smallest[find(k)] if x is not None), default=None) if sets[k] else d)
            for k, (d, _) in enumerate(rows)], n_links


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar_documents(df, **more).collect()), key=repr)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        rng.choice([lambda: words.__setitem__(at, f"new{rng.randrange(10**6)}"), lambda: words.insert(at, "more"), lambda: words.pop(at) if len(words) > 5 else None])()
    return words


@pytest.mark.parametrize(("percent", "shingle"), [(85, 4), (60, 2)])
def test_equals_brute_force(spark, percent, shingle):
    rng = random.Random(percent + shingle)
    rows = []
    for _ in range(14):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([6, 9, 20, 45, 130, 400]))]
        rows += [(len(rows) + i, " ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, len(base) // 25, len(base) // 12])))) for i in range(9)]
    # a passage that many short texts share, and texts of few words
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(1000 + i, passage + " " + " ".join(f"q{rng.randrange(90)}" for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(2000 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 6)))) for i in range(40)]
    rng.shuffle(rows)
    want, n_links = classes(rows, percent, shingle)
    assert n_links > 100
    assert got(spark, rows, percent=percent, shingle=shingle) == sorted(want, key=repr)


def test_every_linked_pair_meets_whatever_the_costs():
    """Each linked pair shares a key of an index row and a probe, also when all
    costs are high and reserves stand in."""
    rng = np.random.default_rng(3)
    for percent, size in ((85, 400), (85, 60), (70, 90), (85, 9)):
        keys = J.Keys(percent)
        for trial in range(60):
            common = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            a, b = np.unique(common), None
            for _ in range(200):
                drop, add = rng.integers(0, size // 5 + 2, 2)
                b = np.unique(np.concatenate([common[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                if (100 + percent) * both >= percent * (len(a) + len(b)):
                    break
            else:
                continue
            cost = rng.integers(0, [1, 50, 2000][trial % 3], J.BUCKETS)
            key, of, role = J.set_rows(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), keys, cost)
            small, large = sorted((0, 1), key=lambda i: (len(a), len(b))[i])
            index = set(key[(of == small) & (role & 1 > 0)].tolist())
            probe = set(key[(of == large) & (role & 2 > 0)].tolist())
            assert index & probe or np.array_equal(a, b)


def test_units_are_as_many_as_segments():
    rng = random.Random(5)
    for _ in range(300):
        m = rng.randrange(1, 40)
        cost = np.array([rng.choice([0.0, 3.0, 90.0, float("inf")]) for _ in range(m)])
        units = J.allocate(cost, cost > 50, np.array([rng.randrange(8) for _ in range(m)]), rng.randrange(1, m + 1))
        assert units.sum() == m and units.min() >= 0 and units.max() <= 2


def test_sets_of_texts():
    long = " ".join(f"word{i % 90_000}" for i in range(400_000))     # several parts
    many = ["", "  \n", "One", "one TWO three", "a b c d", "A\x0bb\x0cc\x1cd e f g", "É é É é É é", "x" * 3000 + " y z w v", long, "a b c d a b c d", "x " * 5000]
    tokens, ends = J.sets_of(many, 4)
    assert np.diff(ends).tolist() == [len(literal(t)) for t in many]
    again = [J.sets_of([t], 4)[0] for t in many]
    assert all(np.array_equal(tokens[i:j], x) for i, j, x in zip(ends, ends[1:], again))
    assert np.array_equal(J.sets_of(["a  B\tc d"], 4)[0], J.sets_of(["A b c D"], 4)[0])
    assert len(np.unique(np.concatenate([J.sets_of([" ".join(p)], 4)[0] for p in (["ab", "c"], ["a", "bc"], ["abc"], ["c", "ab"], ["x" * 256 + "y"], ["y" + "x" * 256])]))) == 6


def test_a_group_of_near_copies_is_not_expanded(spark):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = J.similar_documents(df).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 300


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(3, "a b c d e", 1), (3, "a b c d e", 1), (2, "A b  c\nd e", 2), (None, "a b c d e", 3), (9, None, 4), (8, "", 5), (None, "other words here", 6), (7, " \t", 7), (5, "Other words\there", 8),
            (None, "alone " * 3 + "x", 9)]
    df = (spark.createDataFrame(rows, "doc_id long, text string, node int").withColumn("root", F.lit(1)).withColumn("key", F.lit(1))
          .withColumn("text_key", F.lit("t")).withColumn("a.b", F.lit(1)).withColumn("rep_id", F.lit(4)))
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.similar_documents(df).collect()), key=repr)
    assert found == sorted([(3, 2, 2), (3, 2, 2), (2, 2, 2), (None, 2, 2), (9, 0, 9), (8, 0, 8), (None, 1, 5), (7, 0, 7), (5, 1, 5), (None, 1, None)], key=repr)
    assert J.similar_documents(df.limit(0)).count() == 0
    assert got(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_few_sketches_are_objects_at_a_time():
    """A batch of many pairs costs a task little beside the batch itself."""
    import tracemalloc

    import pyarrow as pa
    n, other = 20 * J.SETS, bytes(2047) + b"\x01"
    sketches = pa.array([bytes(2048), other] * (n // 2), pa.binary())
    numbers = pa.array(range(n), pa.int64())
    sizes = pa.array([100] * n, pa.int64())
    batch = pa.RecordBatch.from_arrays([numbers, numbers, sizes, sizes, sketches, pa.array([other] * n, pa.binary())],
                                       names=["a", "b", "na", "nb", "sa", "sb"])
    tracemalloc.start()
    try:
        found = [x for out in J.possible([batch], 100) for x in out.column("a").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == list(range(1, n, 2))
    assert peak < 6 << 20        # all at once: 21 MB


def test_digests_hold_few_texts_at_a_time():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(5)
    rows = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(400)) for _ in range(3000)] + ["", "one word"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows), pa.array(range(len(rows)), pa.int64())],
                                       names=["doc_id", "text", "text_key"])
    sizes, keys, counts = [], [], 0
    tracemalloc.start()
    try:
        for out in J.digest_rows([batch], 4, 85):
            sizes += [n for n in out.column("n").to_pylist() if n is not None]
            keys += [k for k in out.column("text_key").to_pylist() if k is not None]
            counts += sum(sum(h) for h in out.column("hist").drop_null().to_pylist())
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert keys == list(range(len(rows))) and sizes == [len(literal(t)) for t in rows]
    spaces = J.Spaces(85)
    assert counts == sum(spaces.segments(spaces.band(len(literal(t))))[0] for t in set(rows) if literal(t))
    assert peak < 25 << 20        # all at once: 45 MB


def test_few_jobs_whatever_the_links(spark):
    """Each job leaves threads, classes and statistics with the driver."""
    def jobs(texts):
        group = f"jobs of {len(texts)} texts"
        spark.sparkContext.setJobGroup(group, group)
        try:
            got = J.similar_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4, 85).collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return {r.doc_id: r.component_id for r in got}, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    words = [f"w{i}" for i in range(60)]
    roots, n = jobs(["one text", "another one"])
    assert roots == {0: 0, 1: 1} and n <= 65
    roots, n = jobs([" ".join(words), " ".join(words[1:]), "some other text"])
    assert roots == {0: 0, 1: 0, 2: 2} and n <= 85
