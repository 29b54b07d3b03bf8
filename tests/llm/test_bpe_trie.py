"""The trie encoder against the tokenizers library."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from lociframe.llm.bpe_trie import Encoder, decode, encode_documents, vocabulary
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return Encoder(vocabulary(open(PATH, encoding="utf-8").read()))


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


ODD = ["", " ", "  ", "a", "a  b", "a   b\n\n c", "\t x\r\n", "don't we'll I'M", "x" * 3000, "ab " * 500, "日本語テキスト🙂🙂",
       "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "\x00\x1c\x1f\x85​　 z", "é İi ſ", "=" * 700 + "-" * 300,
       "a \n b", " \n", "a\n ", "123456789 ½ ²³ ٣", "…—“quoted”", "  ᠎ x", "aaaaaaaaaaaaa aaaa", "the the", "é" * 99]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(encoder, library, text):
    got = ids(encoder, text)
    want = library.encode(text, add_special_tokens=False).ids
    assert got == want
    assert decode(encoder.vocab, encoder.encode(text)) == library.decode(want, skip_special_tokens=False)


def test_random_texts(encoder, library):
    rng = random.Random(7)
    letters = "aabcdeehilnorstt  \n\t.,'!-_0129éßñ日🙂 AZ(){}=\"\\"
    for n in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(60)))
        assert ids(encoder, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_small_cache_changes_nothing(library, monkeypatch):
    import lociframe.llm.bpe_trie as M
    monkeypatch.setattr(M, "CACHED", 5)
    monkeypatch.setattr(M, "TRIE_NODES", 9)
    monkeypatch.setattr(M, "CACHED_LENGTH", 4)
    e = Encoder(vocabulary(open(PATH, encoding="utf-8").read()))
    for text in ("one two three four five six seven", "one two eight nine ten", "one"):
        assert ids(e, text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    import __spark_entry__ as E
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in E.queries()["op8_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode(d.text or "", add_special_tokens=False).ids
        raw = np.array(want, "<u4").tobytes()
        back = library.decode(want, skip_special_tokens=False).encode()
        assert got[d.doc_id] == (len(want), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back).hexdigest())


def test_nulls_repeats_extra_columns_and_empty_table(spark):
    rows = [(1, None, "x"), (1, None, "y"), (None, "a b", "z"), (2, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").withColumn("ids", F.lit(1))
    got = encode_documents(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 2), (1, 0), (1, 0), (2, 0)]
    assert encode_documents(df.limit(0), PATH).count() == 0
    assert [len(r.ids) for r in encode_documents(df.where("text = 'a b'"), PATH, with_ids=True).collect()] == [2]


def test_neighbouring_words_share_their_leading_bytes(encoder, library):
    from lociframe.llm.bpe_trie import COMPARED, shared_bytes
    words = sorted([b"", b"a", b"ab", b"ab\0", b"abc", b"b" * 30, b"b" * 31, b"\xc3\xa9", b"\xc3\xaa"])
    assert shared_bytes(words) == [0, 0, 1, 2, 2, 0, COMPARED, 0, 1]
    assert shared_bytes([]) == []
    # blanks at the ends, contractions, letters beyond ASCII, words longer than what is compared
    for t in ["", " ", " a", "a ", "it's 'sword don't", " Été naïve straße", " " + "ab" * 40 + " " + "ab" * 41 + "c", "x1 y²z \x00\x00a a\x00"]:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
