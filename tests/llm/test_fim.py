"""Fill-in-the-middle: the contract literally, and exact round trips."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociframe.llm import fim


def literal(doc_id, text):
    text = text or ""
    n = len(text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return "plain", n, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", n, a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", n, a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_reversals_exchange_blocks(monkeypatch):
    for size in (1, 3, 1 << 16):
        monkeypatch.setattr(fim, "BLOCK", size)
        for n in range(0, 14):
            for cut in range(n + 1):
                buf = bytearray(b"[" + bytes(range(n)) + b"]")
                fim.rotate(buf, 1, 1 + cut, 1 + n)
                assert buf == b"[" + bytes([*range(cut, n), *range(cut)]) + b"]"


def test_code_points_across_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 5)
    text = "aé€😀b" * 9 + "é"
    data = text.encode()
    assert fim.code_points(data) == len(text)
    for a in range(len(text) + 1):
        for b in (a, len(text)):
            assert fim.byte_places(data, [a, b]) == [len(text[:a].encode()), len(text[:b].encode())]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab<>PSMé😀 ", max_size=40), st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4))
def test_round_trip(text, h):
    form, n, p, m, out = fim.rotated(text.encode(), h, 90, 20)
    assert n == len(text) and fim.restored_bytes(form, out) == text.encode()
    assert (form == "plain") == (p is None)
    if form != "plain":
        assert sorted(out) == sorted(text.encode() + b"<P><S><M>")


def test_whole_operator(spark):
    rng = random.Random(1)
    texts = ["", None, "x", "é", "<", "<P", "P>", "a <M> b", "<<<>>>", "日本語のテキスト", "word " * 200_000, "😀" * 999, "a\0b\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (-5, "negative"), (3, "é")]
    rows += [(100 + i, "".join(rng.choice("ab <>PSMé\n") for _ in range(rng.randrange(60)))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit(1)).withColumn("n", F.lit("n")).withColumn("output", F.lit(2)).withColumn("a.b", F.lit(2))
    found = fim.restore(fim.transform(df)).collect()
    assert sorted((repr((r.doc_id, r.form, r.n, r.prefix_chars, r.middle_chars, r.output, r.restored)) for r in found)) == \
        sorted(repr((d, *literal(d, t), t or "")) for d, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fim.restore(fim.transform(df.limit(0))).count() == 0


def test_shares_are_parameters(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("some text to cut").alias("text"))
    assert {r.form for r in fim.transform(df, plain_from=100, spm_below=100).collect()} == {"spm"}
    assert {r.form for r in fim.transform(df, plain_from=0).collect()} == {"plain"}
    assert fim.transform(df, salt="1").exceptAll(fim.transform(df, salt="2")).count() > 0
