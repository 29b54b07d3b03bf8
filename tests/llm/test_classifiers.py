"""Held-out accuracy and corner cases of the two trained classifiers."""

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import quality, toxicity

SF = "/root/testdata/sf0.1"


def scored(spark, name):
    import __spark_entry__ as E
    got = E.queries()[name](spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    label = {"op6_quality": "quality", "op9_toxicity": "toxic"}[name]
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    return got, y


def test_quality_on_held_out_rows(spark):
    got, y = scored(spark, "op6_quality")
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert np.mean([p == t for p, t in held]) >= 0.95
    assert np.mean([p for p, t in held if t == 1]) >= 0.99      # clean documents stay
    assert np.mean([p == 0 for p, t in held if t == 0]) >= 0.65   # a part of the labels is noise


def test_toxicity_on_held_out_rows(spark):
    got, y = scored(spark, "op9_toxicity")
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [(r.predicted, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert np.mean([p == t for p, t in held]) >= 0.97
    assert np.mean([p for p, t in held if t == 1]) >= 0.8
    assert np.mean([p for p, t in held if t == 0]) <= 0.01


def test_offending_sentences_are_located():
    rows = [(f"All is well here {i}. The sky is blue.", 0) for i in range(60)] + [(f"All is well {i}. You utter swine! The sky is blue.", 1) for i in range(20)]
    m = toxicity.train(rows)
    text = "The sky is blue. Such swine you are. All is well."
    score, found = m.score(text)
    assert score > 0.7 and [text[a:b].strip() for a, b, _ in found] == ["Such swine you are."]
    assert m.score("The sky is blue. All is well.")[0] < 0.3 and m.score("")[0] == 0


@pytest.mark.parametrize("module", [quality, toxicity])
def test_training_without_both_classes(module):
    for rows in ([], [("a b.", 0)], [("a b.", 1)]):
        s = module.train(rows).score("a b.")
        assert 0 <= (s if isinstance(s, float) else s[0]) <= 1


def test_very_long_texts():
    rows = [("good words here", 1), ("$$$ &&& ###", 0)] * 5
    assert 0 <= quality.train(rows).score("x" * 300_000 + " good" * 100_000) <= 1
    assert toxicity.train([("a b", 0), ("c d", 1)]).score(" " * 1_000_000)[0] == 0
    assert 0 <= toxicity.train([(t, 1 - y) for t, y in rows]).score("x" * 300_000 + " a." * 100_000)[0] <= 1


def test_nulls_repeats_extra_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(i % 7 if i else None, None if i == 3 else f"text {'$$$' if i % 2 else 'fine'}", i) for i in range(30)],
                                 "doc_id long, text string, score int").withColumn("y", F.lit(1)).withColumn("h", F.lit(2))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(7)] + [(None, 1, 1), (3, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    for module in (quality, toxicity):
        got = module.score_documents(docs, labels).collect()
        assert len(got) == 30 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
        assert module.score_documents(docs.limit(0), labels).count() == 0
        assert module.score_documents(docs, labels.limit(0)).count() == 30
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() <= 30


def test_words_scored_together_have_the_sums_of_their_features(monkeypatch):
    model = quality.Model(np.random.default_rng(3).normal(size=quality.BUCKETS), 0.25)
    words = ["a", "éß", "<x>", "\x00", "\ud800", "y" * 100, "plain", "日本語の"]
    sums, sizes = model.of_words(words)
    assert sizes.tolist() == [len(quality.features(w)) for w in words]
    assert np.allclose(sums, [model.per_feature[quality.features(w)].sum() for w in words])
    # a group's words are found whatever the cache has room for
    monkeypatch.setattr(quality, "CACHED_WORDS", 3)
    monkeypatch.setattr(quality, "GROUP_CHARS", 10)
    texts = ["", "a b a", "  ", " ".join(words), "plain " * 50, "z" * 70 + " a"]
    z = []
    for t in texts:
        of = [quality.features(w) for w in t.split()]
        z.append(0.25 + (sum(model.per_feature[i].sum() for i in of) / sum(map(len, of)) if of else 0))
    assert np.allclose(model.scores(texts), 1 / (1 + np.exp(-np.array(z))))
    assert np.allclose(model.scores(texts[::-1])[::-1], model.scores(texts))
    assert all(len(w) < 64 for w in model.words)
