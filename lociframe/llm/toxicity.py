"""Toxicity by multiple-instance learning.

Only documents are labelled; what offends is some sentence.  Every sentence
gets a logistic score from the hashed features of its words, and a document is
toxic unless each of its sentences is harmless (noisy-or):
P(document) = 1 - product of (1 - p(sentence)).  The gradient of the document's
likelihood goes back to the sentences in proportion to their blame.  Training
is numpy gradient descent (Adagrad) on a bounded, documented sample of labelled
rows; scoring reads whole texts sentence by sentence and also locates the
offending sentences.

Defined results: a null or empty text has no sentence and scores 0; a training
sample without both classes scores its share of toxic rows on every text with
words (without any rows 0); repeated rows are scored each; an empty table gives
an empty result.  Labels, language, source and id are never inputs; only the
named columns are read, so further columns never clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import crc_bucket, labelled_sample, texts

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7)   # stems, as far as letters at a word's start can tell them
SEEN_IN = 3                  # a feature that fewer toxic training documents hold has no weight,
LIFT = 3.0                   # nor has one that is not this many times as frequent in toxic ones
EPOCHS = 15
RATE = 1.0
PULL = 2e-4                  # weight decay
START = -4.0                 # logit of a sentence without features
MAX_DOCS = 5000
MAX_CHARS = 30_000
CACHED_WORDS = 200_000      # words whose weight a task remembers

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")     # linear: blank ones are skipped afterwards
WORD = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """Hashed ids of a lower-case word and of its beginnings."""
    b = word.encode("utf-8", "surrogatepass")
    return [crc32(b) & (BUCKETS - 1), *{crc32(word[:n].encode("utf-8", "surrogatepass"), n) & (BUCKETS - 1) for n in PREFIXES if len(word) > n}]


def sentences(text: str) -> Iterator[re.Match]:
    return (m for m in SENTENCE.finditer(text) if not m[0].isspace())


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.words = weights, bias, {}

    def __reduce__(self):
        return Model, (self.weights, self.bias)

    def word(self, word: str) -> float:
        w = self.words.get(word)
        if w is None:
            if len(self.words) > CACHED_WORDS:
                self.words.clear()
            w = float(self.weights[features(word)].sum())
            if len(word) < 64:
                self.words[word] = w
        return w

    def sentence(self, text: str) -> float:
        """Probability that a sentence offends; a word counts once."""
        z = self.bias + sum(map(self.word, set(WORD.findall(text.lower()))))
        return float(1 / (1 + np.exp(-max(-500.0, min(500.0, z)))))

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of a text, and (start, end, p) of the sentences with p >= 0.5."""
        harmless, found = 0.0, []
        for m in sentences(text):
            p = min(self.sentence(m[0]), 1 - 1e-12)
            harmless += np.log1p(-p)
            if p >= 0.5:
                found.append((m.start(), m.end(), p))
        return float(1 - np.exp(harmless)), found


def train(rows: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> Model:
    n = sum(y for _, y in rows)
    if not 0 < n < len(rows):
        return Model(np.zeros(BUCKETS), 0.0 if n else -500.0)
    known: dict[str, list[int]] = {}

    def of_word(w: str) -> list[int]:
        ids = known.get(w)
        if ids is None:
            if len(known) > 100_000:
                known.clear()
            ids = known[w] = features(w)
        return ids

    # screening: what could tell an offending sentence at all
    seen = np.zeros((2, BUCKETS), np.int32)
    for text, y in rows:
        ids = {i for w in set(WORD.findall(text.lower())) for i in of_word(w)}
        seen[y, np.fromiter(ids, np.int64, len(ids))] += 1
    used = (seen[1] >= SEEN_IN) & (seen[1] / n >= LIFT * (seen[0] + 1) / (len(rows) - n))
    # bags: for each document the used features of its sentences (flat, with
    # the number of the sentence each belongs to)
    bags = []
    for text, _ in rows:
        flat, owner, sentence = [], [], 0
        for m in sentences(text):
            for w in set(WORD.findall(m[0].lower())):
                ids = [i for i in of_word(w) if used[i]]
                flat += ids
                owner += [sentence] * len(ids)
            sentence += 1
        bags.append((np.array(flat, np.int32), np.array(owner, np.int32), sentence))
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    bias, bias_square = START, 1.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            flat, owner, count = bags[k]
            if not count:
                continue
            z = bias + np.bincount(owner, weights[flat], count)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            harmless = np.exp(np.log1p(-np.minimum(p, 1 - 1e-9)).sum())
            # d(-log likelihood) / d(logit of each sentence)
            blame = -p * harmless / max(1 - harmless, 1e-9) if rows[k][1] else p
            ids, at = np.unique(flat, return_inverse=True)
            g = np.bincount(at, blame[owner], len(ids)) + PULL * weights[ids]
            squares[ids] += g * g
            weights[ids] -= rate * g / np.sqrt(squares[ids])
            g = blame.sum()
            bias_square += g * g
            bias = min(bias - 0.05 * rate * g / np.sqrt(bias_square), -3.0)
    return Model(weights, float(bias))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model:
    return train(labelled_sample(docs, labels, "toxic", learn, max_docs, max_chars))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 3, left_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted, sentences) for every row; sentences:
    start:end of those that offend by themselves, comma-joined.  Rows whose id
    falls into the left-out bucket are never learnt from."""
    out = F.coalesce(crc_bucket(F.col("doc_id"), modulus) == left_out, F.lit(False))
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, ~out))

    def run(batches):
        # the word cache lives as long as the task: the worker keeps the broadcast
        model = Model(sent.value.weights, sent.value.bias)
        for b in batches:
            scored = [model.score(t) for t in texts(b.column(2))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([s for s, _ in scored], pa.float64()),
                 pa.array([int(s >= threshold) for s, _ in scored], pa.int32()),
                 pa.array([",".join(f"{a}:{z}" for a, z, _ in found) for _, found in scored], pa.string())],
                names=["doc_id", "held_out", "score", "predicted", "sentences"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, sentences string")
