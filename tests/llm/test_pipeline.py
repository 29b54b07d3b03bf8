"""The pipeline's stages against brute force on the smallest tables."""

import hashlib
import re
from zlib import crc32

import numpy as np
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as P
import public_tokenizers
from lociframe.llm import quality
from lociframe.llm.common import labelled_sample
from tests.llm.test_secrets import literal
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def one_of_each(docs):
    ids = sorted(docs)
    prints = np.array([fingerprint(docs[i]) for i in ids], np.uint64)
    group = list(range(len(ids)))
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 2):
            a, b = sorted((group[i], group[int(j)]))
            group = [a if g == b else g for g in group]
    return {ids[g] for g in set(group)}


def test_run_equals_brute_force(spark):
    got = {r.doc_id: r for r in P.run(spark, SF).collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r.doc_id: r.text for r in table.collect()}
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = quality.train(labelled_sample(table, spark.read.parquet(f"{SF}/labels.parquet"), "quality", learn, quality.MAX_DOCS, quality.MAX_CHARS))
    good = {d: t for d, t in docs.items() if model.score(t) >= 0.3}
    first = one_of_each(good)
    plain = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d in first if not any(i in plain(good[d]) for i in items)}
    assert set(got) == clean and len(clean) < len(first) < len(good) < len(docs)
    library = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    for d in clean:
        spans = [x.split(":") for x in literal(good[d]).split(",") if x]
        text, at = "", 0
        for kind, a, b in spans:
            if int(a) >= at:
                text += good[d][at:int(a)] + f"[{kind} removed]"
            at = max(at, int(b))
        text += good[d][at:]
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(got[d].ids) == ids and got[d].n_tokens == len(ids)
        assert got[d].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_columns_and_survive_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(None, None, None, None, None), (7, None, "en", "s", 0), (7, "", "en", "s", 0), (7, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("score", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("kept_id", F.lit(2))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_order_and_registration():
    import __spark_entry__ as E
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "bpe_encoding"]
    names = list(E.queries())
    assert "pipeline" in names and [n.split("_")[0] for n in names if re.match(r"op\d+_", n)] == [f"op{i}" for i in range(1, 14)]
    assert crc32(b"5") % 5 in range(5)
