"""Leaks against brute force over literal passages, and planted variants."""

import random
import re

from pyspark.sql import functions as F

from lociframe.llm import decontam
from lociframe.llm.decontam import drop_leaking, leaks, templates

SF = "/root/testdata/sf0.01"
ITEM = ("A train leaves Boston at 9 and travels 120 km in 3 hours while Alice Smith counts 45 red cars along the old road and 9 blue "
        "ones near the bridge")


def test_query_finds_every_planted_passage_and_no_clean_document(spark):
    import __spark_entry__ as E
    got = {(r.doc_id, r.item_id) for r in E.queries()["op1_decontam"](spark, SF).collect()}
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    docs = {r.doc_id: f" {plain(r.text)} " for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert {(d, i) for d, t in docs.items() for i, p in items.items() if f" {p} " in t} <= got
    # every finding shares a run of words with its item
    for d, i in got:
        words = items[i].split()
        assert any(" ".join(words[k:k + 8]) in docs[d] for k in range(max(1, len(words) - 7)))


def found(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, hash string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").withColumn("pos", F.lit(1))
    return {(r.doc_id, r.item_id): r for r in leaks(docs, bench).collect()}


def test_reparameterised_questions(spark):
    swapped = (ITEM.replace("Boston", "Denver").replace("Alice Smith", "Bob").replace("120 km", "75 miles").replace("45", "12")
               .replace(" 9 ", " 7 "))
    broken = ITEM.replace("at 9", "at 4")          # the item's two nines became different numbers
    got = found(spark, [f"Some words before. {ITEM} and after.", f"before {swapped} after", broken, "A train leaves Boston at 9.", ITEM.upper(),
                        "1 2 3 4 5 6 7 8 9 10 11 12 " * 50, "", None, ITEM.replace(" ", "\n  ")])
    assert {d for d, _ in got} >= {0, 1}
    assert {d for d, _ in got} <= {0, 1, 4, 8}
    assert got[0, 0].n_changed == 0 and got[0, 0].n_slots >= 6 and got[0, 0].coverage > 0.8
    assert got[1, 0].n_changed >= 5


def test_short_items_long_texts_repeats(spark):
    long = "filler words go here and there " * 60_000 + "what is the capital of modern France" + " more of it" * 60_000
    got = found(spark, [long, "what is the capital of modern France"], ["What is the capital of modern France?", "too short", "", None])
    assert set(got) == {(0, 0), (1, 0)}


def test_stage_keeps_clean_rows_and_columns(spark):
    rows = [(1, ITEM, "a"), (1, "clean", "b"), (1, "clean", "b"), (None, ITEM, "c"), (None, None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leak_key string")
    bench = spark.createDataFrame([(5, ITEM), (5, ITEM), (None, ITEM)], "item_id long, text string")
    kept = drop_leaking(docs.withColumnRenamed("leak_key", "width"), bench)
    assert kept.columns == ["doc_id", "text", "width"]
    assert sorted(r.width for r in kept.collect()) == ["b", "b", "d"]
    assert drop_leaking(docs.limit(0).drop("leak_key"), bench).count() == 0
    assert drop_leaking(docs.drop("leak_key"), bench.limit(0)).count() == 5


def test_words_put_in_or_left_out_of_a_passage(spark):
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("ral", "mon", "tig", "sel", "vun", "kep", "dor")]
    short, long = " ".join(words[:30]), " ".join(words)
    put = lambda t, k, x="quite": " ".join([*t.split()[:k], x, *t.split()[k:]])
    out = " ".join(w for k, w in enumerate(long.split()) if k != 28)
    tale = "a train leaves the old town at 5 and then goes along 12 red bridges over one small river for its people"
    more = tale.replace(" 5 ", " twenty five ").replace(" 12 ", " 3 1/2 ")
    scattered = " ".join(" ".join(words[k:k + 8]) + " x" * 40 for k in (0, 12, 20))
    docs = [put(short, 15), "some text " + put(long, 28), out, put(put(long, 20), 40, "so very"), more, scattered,
            " ".join(reversed(short.split())), f"{put(short, 15)} and again {put(short, 15)}"]
    got = found(spark, docs, [short, long, tale])
    assert {(0, 0), (1, 1), (2, 1), (3, 1), (7, 0)} <= set(got)
    assert got[0, 0].n_matched == 16 and got[7, 0].n_matched == 16 and got[0, 0].first_token == 0
    assert not {d for d, _ in got} & {5, 6}


def test_chain_rises_in_both_texts():
    from lociframe.llm.decontam import chain
    assert chain([(0, 0), (1, 1), (5, 2), (6, 3)]) == [(0, 0), (1, 1), (5, 2), (6, 3)]
    assert chain([(0, 5), (1, 6), (2, 7), (3, 0)]) == [(0, 5), (1, 6), (2, 7)]
    two = [(k, k) for k in range(9)] + [(k + 30, k) for k in range(9)]
    assert len({d - p for d, p in chain(two)}) == 1 and len(chain(two)) == 9


def test_names_in_every_place_and_case(spark):
    tom = "Tom has 3 apples. Tom buys 5 more. Tom eats 2. How many apples does Tom have left?"
    start = "Tom has 3 red apples in the box. Tom then buys 5 more of them."      # never inside a sentence
    docs = [tom.replace("Tom", "Sam"), tom.lower(), tom.upper(), start.replace("Tom", "Anna Lee"), ITEM.lower(),
            f"Other words come first. {tom.replace('Tom', 'Sam').replace('5', '8')} And some go after.", tom.replace("Tom", "Sam").replace("SAM", "sam")]
    got = found(spark, docs, [tom, start, ITEM])
    assert {(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 0), (6, 0)} <= set(got)
    assert {i for d, i in got if d == 4} == {2}
    assert got[0, 0].n_changed > 0


def test_one_conflict_in_many_slots_and_items_without_windows(spark):
    many = " and ".join(f"the old box number {k} holds some {k + 50} coins" for k in (1, 2, 3, 4, 5, 6, 7, 1))
    digits, tiny, sums = "3 1 4 1 5 9 2 6 5 3 5", "Why not?", "What is 7 times 8?"
    docs = [many.replace("number 1", "number 9", 1), f"so {digits} it is", digits.replace("9", "8"), "why NOT", "and why not today",
            "He asked: what is 7 times 8? Then he left", "what is 7 times 9"]
    assert set(found(spark, docs, [many, digits, tiny, sums])) == {(0, 0), (1, 1), (3, 2), (5, 3)}


def test_items_of_one_template_are_one_row_for_a_document(spark):
    rng = random.Random(4)
    ask = "A farmer brings {} apples and {} pears to the market and sells {} of them before noon"
    items = [ask.format(*rng.sample(range(100, 9000), 3)) for _ in range(2000)] + [ask.format(7, 7, 9), ITEM]
    docs = [ask.format(*rng.sample(range(10_000, 99_000), 3)) for _ in range(197)] + [items[17], ask.format(5, 5, 6), ITEM]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = leaks(df, bench).collect()
    assert len({r.template for r in got}) == 3
    by = {(r.doc_id, r.n_items): r for r in got}
    assert len(got) <= 2 * 199 + 1 and {d for d, _ in by} == set(range(200))
    assert by[3, 2000].item_id == 0 and by[3, 2000].n_changed == 3
    assert by[197, 2000].item_id == 17 and by[197, 2000].n_changed == 0 and by[199, 1].item_id == 2001
    assert (198, 1) in by and (3, 1) not in by       # equal numbers stay equal: the template of 7, 7, 9
    listed = templates(bench).select("item_id", "template").distinct()
    assert sorted(r["count"] for r in listed.groupBy("template").count().collect()) == [1, 1, 2000]


def test_long_names_are_compared_whole(spark):
    name = "Anna Maria Lena Clara Sofia Greta Olga Irma Lee"
    item = f"the old town hall was built by {name} long ago and {name} lived there with {name} until the end"
    other = item.replace("Greta Olga Irma Lee long", "Greta Olga Irma Roe long")
    assert found(spark, [item, other], [item])[0, 0].n_changed == 0
    # nine words agree in the first six only: one slot of three conflicts
    assert (1, 0) not in found(spark, [item, other], [item])


def test_second_probe_is_of_the_places_that_pass_the_first():
    import numpy as np
    from lociframe.llm.decontam import BLOOM_BITS, PROBES, maybe, probe
    h = np.random.default_rng(1).integers(0, 1 << 64, 4000, np.uint64)
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    for i in range(PROBES):
        byte, bit = probe(h[:500], i)
        assert byte.min() >= 0 and byte.max() < len(bits)
        np.bitwise_or.at(bits, byte, bit)
    at = maybe(bits, h, np.arange(0, 4000, 2))
    assert set(range(0, 500, 2)) <= set(at.tolist()) and len(at) < 270 and (at % 2 == 0).all()


def test_tokens_are_cut_at_spaces_and_cached(monkeypatch):
    def expected(text):
        tokens = decontam.Tokens()
        n = [tokens[w] for w in decontam.TOKEN.findall(text)]
        return [(tokens.hashes[i], tokens.kinds[i]) for i in n]

    rng, parts = random.Random(5), ["Word", "word", "ÉTÉ", "straße", "ª²", "٣", "1", "2,5", ".", ",", "?", "!", "\n", " ", "  ", "\t", " ", "_", "-", "%", "€", "a1b", "km"]
    texts = ["", " ", "\n", "1. 2", "1, 2", "3.4. Next", "one,two three.", "x" * 200, "ab-" * 200 + " end. Start", "a. . b, , c"]
    texts += ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(500)]
    tokens = decontam.Tokens()
    for text in texts * 2:
        assert [(tokens.hashes[i], tokens.kinds[i]) for i in tokens.numbers(text).tolist()] == expected(text)
    # words in plain text, and pieces seen before, are not looked for again
    calls, pattern = [], decontam.TOKEN
    monkeypatch.setattr(decontam, "TOKEN", type("", (), {"findall": lambda self, t: calls.append(t) or pattern.findall(t)})())
    tokens = decontam.Tokens()
    for _ in range(3):
        tokens.forms("Some plain words, and some more. Then others.")
    assert sorted(calls) == [".", "others."]
    # a long piece of several tokens is not kept
    tokens.numbers("ab-" * 1000)
    assert max(map(len, tokens)) <= decontam.LONG
