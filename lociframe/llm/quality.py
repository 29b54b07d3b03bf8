"""Quality classifier: supervised subword embeddings.

Each word and each character n-gram of it owns a vector, found by hash.  A
document is the average of the vectors of all its words' features; a softmax
layer turns it into class probabilities.  Vectors and layer are trained
together by numpy stochastic gradient descent on a bounded, documented sample
of labelled rows (``max_docs`` rows of at most ``max_chars`` characters, those
with the smallest id hash), collected as text by the driver.

The score is linear in the document vector, so a task keeps one number per
known word (the sum of its features' scores) and reads whole texts of any
length with a bounded word cache; the new words of a group of texts are hashed
and scored together.  Nothing is shuffled when scoring.

Defined results: a null or empty text has the score of the layer's bias; a
training sample without both classes gives its only label's share (without any
rows 0.5) to all; repeated rows are scored each; an empty table gives an empty
result.  Labels, language, source and id are never inputs; only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import crc_bucket, labelled_sample

BUCKETS = 1 << 16        # hashed vectors
DIM = 12
NGRAMS = (2, 3, 4)       # lengths in bytes of "<word>"
EPOCHS = 8
RATE = 6.0
MAX_DOCS = 3000
MAX_CHARS = 30_000
CACHED_WORDS = 100_000      # words whose score a task remembers
GROUP_CHARS = 1 << 19       # texts whose words are learnt together
WORDS = 20_000              # words hashed at a time


def features(word: str) -> list[int]:
    """Hashed ids of a word and of its character n-grams."""
    b = b"<" + word.encode("utf-8", "surrogatepass") + b">"
    ids = [crc32(b[i:i + n]) & (BUCKETS - 1) for n in NGRAMS for i in range(len(b) - n + 1)]
    ids.append(crc32(b, 1) & (BUCKETS - 1))
    return ids


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids of a text and the share of each."""
    counts: Counter = Counter()
    for word, n in Counter(text.split()).items():
        for i in features(word):
            counts[i] += n
    ids = np.fromiter(counts.keys(), np.int64, len(counts))
    share = np.fromiter(counts.values(), np.float64, len(counts))
    return ids, (share / share.sum() if len(share) else share).astype(np.float32)


def _byte_tables() -> dict[int, list[np.ndarray]]:
    """By n-gram length, for each place the id bits that a byte there gives: crc32
    is linear, so the id of an n-gram is the exclusive or of its bytes' bits."""
    out = {}
    for n in NGRAMS:
        zero = crc32(bytes(n))
        out[n] = [np.array([(crc32(bytes(i) + bytes([x]) + bytes(n - 1 - i)) ^ (zero if i else 0)) & (BUCKETS - 1) for x in range(256)], np.int32)
                  for i in range(n)]
    return out


TABLES = _byte_tables()


class Model:
    """``score`` per feature (the difference of the two classes' logits) and bias."""

    def __init__(self, per_feature: np.ndarray, bias: float):
        self.per_feature, self.bias = per_feature.astype(np.float64), float(bias)
        self.start()

    def __reduce__(self):
        return Model, (self.per_feature, self.bias)

    def start(self) -> None:
        """No word is known: number of each word, and by number the sum of its
        features' scores and how many they are."""
        self.words: dict[str, int] = {}
        self.sums, self.sizes = np.zeros(1 << 12), np.zeros(1 << 12)
        self.used = 0

    def of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of each word's ``features`` scores and their number; words hold no
        line feed, which parts them here."""
        data = ("<" + ">\n<".join(words) + ">\n").encode("utf-8", "surrogatepass")
        raw = np.frombuffer(data + bytes(max(NGRAMS)), np.uint8)
        ends = np.flatnonzero(raw[:len(data)] == 10)
        starts = np.concatenate([[0], ends[:-1] + 1])
        # bytes from each place to the end of its word
        left = np.repeat(ends, ends - starts + 1) - np.arange(len(data))
        value = np.zeros(len(data))
        for n in NGRAMS:
            ids = TABLES[n][0][raw[:len(data)]]
            for i in range(1, n):
                ids ^= TABLES[n][i][raw[i:i + len(data)]]
            value += np.where(left >= n, self.per_feature[ids], 0.0)
        whole = np.fromiter((crc32(w, 1) for w in data[:-1].split(b"\n")), np.int64, len(words)) & (BUCKETS - 1)
        size = ends - starts
        return (np.add.reduceat(value, starts) + self.per_feature[whole],
                1.0 + sum(np.maximum(size - n + 1, 0) for n in NGRAMS))

    def learn(self, words: set[str]) -> list[str]:
        """Numbers for the words that have none; returns those too long to be kept."""
        fresh = words.difference(self.words)
        if len(self.words) + len(fresh) > CACHED_WORDS or self.used > 2 * CACHED_WORDS:
            self.start()
            fresh = words
        if not fresh:
            return []
        fresh = list(fresh)
        n = self.used + len(fresh)
        if n > len(self.sums):
            self.sums, self.sizes = np.resize(self.sums, 2 * n), np.resize(self.sizes, 2 * n)
        for at in range(0, len(fresh), WORDS):
            to = self.used + min(at + WORDS, len(fresh))
            self.sums[self.used + at:to], self.sizes[self.used + at:to] = self.of_words(fresh[at:at + WORDS])
        self.words.update(zip(fresh, range(self.used, n)))
        self.used = n
        return [w for w in fresh if len(w) >= 64]

    def scores(self, batch: list[str]) -> list[float]:
        """The score of every text; groups of texts of bounded size learn words together."""
        out: list[float] = []
        group, size = [], 0
        for text in batch:
            group.append(text.split())
            size += len(text)
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, group: list[list[str]]) -> list[float]:
        long = self.learn(set().union(*group))
        z = np.full(len(group), self.bias)
        for k, words in enumerate(group):
            if words:
                at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
                z[k] += self.sums[at].sum() / self.sizes[at].sum()
        for w in long:
            del self.words[w]
        return (1 / (1 + np.exp(-np.clip(z, -500.0, 500.0)))).tolist()

    def score(self, text: str) -> float:
        return self.scores([text])[0]


def train(rows: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> Model:
    """Stochastic gradient descent over (text, label) rows, one row a step."""
    share = (sum(y for _, y in rows) + 1) / (len(rows) + 2)
    if not 0 < sum(y for _, y in rows) < len(rows):
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    docs = [(*document_features(t), y) for t, y in rows]
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, step = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            ids, share_of, y = docs[k]
            lr = rate * (1 - step / steps)
            step += 1
            own = vectors[ids]
            hidden = share_of @ own
            z = hidden @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = layer @ p
            layer -= np.float32(0.1 * lr) * np.outer(hidden, p)
            bias -= np.float32(0.002 * lr) * p
            vectors[ids] = own - np.float32(lr) * np.outer(share_of, back)
    return Model(vectors @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model:
    return train(labelled_sample(docs, labels, "quality", learn, max_docs, max_chars))


def scorer(model: Model, df: DataFrame):
    """Text column -> score column; the model (one number per hashed feature, a
    fixed size) is sent to the executors once."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # the word cache lives as long as the task: the worker keeps the broadcast
        model = Model(sent.value.per_feature, sent.value.bias)
        for text in batches:
            yield pd.Series(model.scores([t if isinstance(t, str) else "" for t in text]), dtype="float64")

    return score


def held_out(modulus: int, left_out: int) -> Column:
    return F.coalesce(crc_bucket(F.col("doc_id"), modulus) == left_out, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5, left_out: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; rows whose id falls
    into the left-out bucket are never learnt from."""
    out = held_out(modulus, left_out)
    score = scorer(fit(docs, labels, ~out), docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), out.alias("held_out"), score(F.col("text").cast("string")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5, left_out: int = 0) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; all columns stay."""
    score = scorer(fit(docs, labels, ~held_out(modulus, left_out)), docs)
    return docs.where(score(F.col("text").cast("string")) >= threshold)
