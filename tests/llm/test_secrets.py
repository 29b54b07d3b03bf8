"""Base spans against a literal reading of the rule; linking on small texts."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from lociframe.llm.secrets import base_spans, linked, redact, redact_documents, scan, scan_documents

SF = "/root/testdata/sf0.01"
KEY = "AKIA" + "ABCDEFGH12345678"
B64 = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEYab"


def literal(text):
    """Base spans straight from the rule, without any shortcut."""
    rules = [("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    found = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, good) in enumerate(rules)
             for m in re.finditer(p, text) if good(m)]
    return ",".join(x[2] for x in sorted(found))


def base(text):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in scan(text)[0])


def test_base_spans_on_random_texts():
    rng = random.Random(3)
    bits = ["password", "PassWD", "secret", "ToKen", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "abc", "0123456789abcdef" * 2,
            "abcdef", KEY, "AKIA", "AKIAAKIA", "\n", "ſecret", "toKen", "é", "x.y/z+=-", "Z9"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(14)))
        assert base(text) == literal(text), repr(text)


def test_weak_parts_need_company():
    assert linked(f"the hash {B64} alone", []) == []
    pair = f"client_id = web42\nnothing {B64}\nhttps://db.example.org/x"
    assert [p[0] for p in linked(pair, base_spans(pair))] == ["ident", "secret", "endpoint"]
    far = f"client_id = web42\n\n{B64}"
    assert linked(far, base_spans(far)) == []
    apart = "client_id = web42 " + "x " * 400 + B64
    assert linked(apart, base_spans(apart)) == []
    cloud = f"{KEY} {B64}"
    assert [p[0] for p in scan(cloud)[1]] == ["access", "secret"]
    assert linked("see https://example.org/page and user = bob", []) == []


def test_redaction():
    assert redact("nothing here") == "nothing here" and redact("") == ""
    assert redact(f'a token = "{"0a" * 20}" b') == 'a [assign removed]" b'
    assert redact(f"id {KEY}.") == "id [access removed]."


def test_many_parts_stay_fast():
    text = f"user = bob {'f' * 30} " * 5000
    assert len(scan(text)[1]) == 10000


def test_query_against_the_rule(spark):
    import __spark_entry__ as E
    got = {r.doc_id: r for r in E.queries()["op10_secrets"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    hits = 0
    for d in docs:
        want = literal(d.text or "")
        r = got[d.doc_id]
        kinds = [x.split(":")[0] for x in want.split(",") if x]
        hits += len(kinds)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
    assert hits


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, "s"), (1, "token=abcdef", "t"), (1, "token=abcdef", "t"), (None, "", None)],
                               "doc_id long, text string, spans string").withColumn("n_hex", F.lit("x"))
    got = sorted((r.doc_id or 0, r.n_assign, r.spans) for r in scan_documents(df).collect())
    assert got == [(0, 0, ""), (1, 0, ""), (1, 1, "assign:0:12"), (1, 1, "assign:0:12")]
    assert scan_documents(df.limit(0)).count() == 0
    clean = redact_documents(df.withColumn("n_chars", F.length("text").cast("long")))
    assert clean.columns == [*df.columns, "n_chars"]
    assert sorted((r.text or "", r.n_chars or 0) for r in clean.collect()) == [("", 0), ("", 0), ("[assign removed]", 16), ("[assign removed]", 16)]


def test_parts_of_any_length_are_whole():
    name, url = "Ab1_" * 18, "postgres://db.example.org/" + "q" * 300
    text = f"client_id = {name}\n{B64}\n{url} end"
    assert redact(text) == "[ident removed]\n[secret removed]\n[endpoint removed] end"
    rng = random.Random(5)
    for n, pad, letters in ((32, "", "aB3xY9"), (43, "=", "Zz0+/q"), (64, "", "k7Qw_-"), (86, "==", "aB3xY9"),
                            (48, "", "abcdefghijklmnopqrstuvwxyz0123456789")):
        key = "".join(rng.choice(letters) for _ in range(n - 3)) + ("a7b" if letters.islower() else "aB7")
        assert redact(f"login: bob {key}{pad} x") == "[ident removed] [secret removed] x"
    assert linked(f"login: bob {'internationalization_of_words_and_names'}", []) == []


def test_a_long_preceding_part_is_beside():
    text = "token=" + "a.b=" * 150 + " user: bob"
    assert [p[0] for p in scan(text)[1]] == ["assign", "ident"]
    far = "token=abcdef" + " x" * 250 + " user: bob"
    assert [p[0] for p in scan(far)[1]] == ["assign"]
