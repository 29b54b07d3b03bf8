"""Training-data pipeline over ``documents``: quality, near-duplicates,
benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet below the shared checkpoint folder and hands the reread table on,
so a lost executor repeats a part of one stage only.  All stages but the last
return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lociframe.llm import bpe_trie, decontam, quality, secrets, simhash
from lociframe.llm.common import stored, table

TOKENIZER = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects (score under 0.3); it is
    trained on labelled rows of ``docs`` outside its held-out fifth."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3, modulus=5, left_out=0)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each near-duplicate component
    (shingles of 3 words, at most 2 differing bits)."""
    return simhash.keep_one_of_each(docs, shingle=3, max_distance=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that leak an item of ``benchmark``."""
    return decontam.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets inside ``text`` and counts ``n_chars`` anew."""
    return secrets.redact_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with their digest and that of the decoded text."""
    return bpe_trie.encode_documents(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]

#: trained scores, bit counts and merges are beyond SQL; tests/llm holds run()
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
