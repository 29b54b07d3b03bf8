"""Property checks against brute-force Python on random small inputs."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions.alleles import with_min_rep

BASES = st.text(alphabet="ACGT", min_size=1, max_size=6)


def brute_min_rep(pos, ref, alt):
    # suffix first, then prefix; each allele keeps at least one base
    while len(ref) > 1 and len(alt) > 1 and ref[-1] == alt[-1]:
        ref, alt = ref[:-1], alt[:-1]
    while len(ref) > 1 and len(alt) > 1 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(BASES, BASES), min_size=1, max_size=60))
def test_min_rep_matches_brute_force(spark, pairs):
    rows = [(i, 1000 + i, r, a) for i, (r, a) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, position long, ref string, alt string")
    got = {r.i: (r._mr_pos, r._mr_ref, r._mr_alt)
           for r in with_min_rep(df, "position", "ref", "alt").select("i", "_mr_pos", "_mr_ref", "_mr_alt").collect()}
    for i, pos, ref, alt in rows:
        assert got[i] == brute_min_rep(pos, ref, alt), (ref, alt)


def brute_split_pl(pl, a):
    n = 0
    out = {0: [], 1: [], 2: []}
    k = 0
    while n < len(pl):
        for j in range(k + 1):
            if n < len(pl):
                out[(j == a) + (k == a)].append(pl[n])
                n += 1
        k += 1
    return [min(out[c]) for c in (0, 1, 2)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 10_000)), min_size=1, max_size=40))
def test_split_pl_matches_brute_force(spark, cases):
    rows = []
    for i, (nalt, seed) in enumerate(cases):
        n_gt = (nalt + 1) * (nalt + 2) // 2
        pl = [(seed * 7 + 13 * j) % 97 for j in range(n_gt)]
        for a in range(1, nalt + 1):
            rows.append((i, a, nalt + 1, pl))
    df = spark.createDataFrame(rows, "i int, a_index int, num_alleles int, PL array<int>")
    out = G.with_split_pl(df).collect()
    for r in out:
        src = next(x for x in rows if x[0] == r.i and x[1] == r.a_index)
        assert list(r.PL) == brute_split_pl(src[3], r.a_index)


def test_downcode_matches_brute_force(spark):
    rows = [(a1, a2, ph, a) for a1 in range(4) for a2 in range(4) for ph in (False, True) for a in (1, 2, 3)]
    df = spark.createDataFrame(rows, "a1 int, a2 int, ph boolean, a int")
    got = df.select("a1", "a2", "ph", "a", G.downcode(F.struct(F.col("a1").alias("a1"), F.col("a2").alias("a2"),
                                                                F.col("ph").alias("phased")), F.col("a")).alias("d"))
    for r in got.collect():
        d1, d2 = int(r.a1 == r.a), int(r.a2 == r.a)
        exp = (d1, d2) if r.ph else tuple(sorted((d1, d2)))
        assert (r.d.a1, r.d.a2) == exp
