"""Phrase collocations against a literal count, over small chunks as well."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lociframe.llm import collocations as C


def literal(rows, longest=4, least=30, scale=2_000_000, covered=80, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        many = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in many.items():
            if any(100 * b >= covered * a for q, b in many.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))):
                continue
            score, k = min((scale * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            kept.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], score))
        kept.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, i, *r[1:]) for i, r in enumerate(kept[:top], 1)]
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.collocations(df, **more).collect())


def corpus(seed):
    rng = random.Random(seed)
    words = ["The", "of", "a", "in", "é", "x\x01y", "Über", "tab"] + [f"w{i}" for i in range(25)]
    fixed = ["new york city", "in the middle of", "a b", "the the the the the"]
    rows = []
    for i in range(220):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(rng.randrange(0, 50))]
        rows.append((rng.choice(["en", "en", "de", None]), "".join(p + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "?! "]) for p in parts)))
    return rows


@pytest.mark.parametrize(("chunk", "least", "longest"), [(1 << 19, 30, 4), (7, 5, 4), (33, 6, 5)])
def test_equals_literal_count(spark, monkeypatch, chunk, least, longest):
    monkeypatch.setattr(C, "CHUNK", chunk)
    rows = corpus(chunk)
    want = literal(rows, least=least, longest=longest)
    assert len(want) > 15
    assert found(spark, rows, least=least, longest=longest) == want


def test_top_and_cover_are_parameters(spark):
    rows = corpus(3)
    assert found(spark, rows, least=5, top=4, covered=50) == literal(rows, least=5, top=4, covered=50)


def test_one_long_piece_crosses_chunks(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 100)
    rows = [("en", "a b c d e " * 400), ("en", "f g " * 300 + "." + " g f" * 35)]
    assert found(spark, rows) == literal(rows)


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(None, "x y " * 40), ("und", "x y " * 5), ("en", None), ("en", ""), ("fr", " . , "), (None, "x y " * 40), ("en", "rare words only")]
    df = (spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit("n"))
          .withColumn("chunk", F.lit(1)).withColumn("a.b", F.lit(1)))
    got = sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.collocations(df).collect())
    assert got == literal(rows) and got[0][0] == "und"
    assert C.collocations(df.limit(0)).count() == 0
    assert C.collocations(df.where("lang = 'en'")).count() == 0
