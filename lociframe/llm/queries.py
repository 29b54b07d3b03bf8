"""Registered queries of the training-data operators and of the pipeline."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.llm import fim, quality, toxicity
from lociframe.llm.bpe_trie import encode_documents
from lociframe.llm.chat import CONTROL, assemble, format_turns, read_back
from lociframe.llm.collocations import collocations
from lociframe.llm.common import table
from lociframe.llm.decontam import leaks
from lociframe.llm.secrets import scan_documents
from lociframe.llm.set_join import similar_documents
from lociframe.llm.simhash import near_duplicates
from lociframe.llm.style_tree import extract_pages
from lociframe.llm.topk import top_k
from lociframe.llm.warc import read_archives, write_archives


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that leak a benchmark item, a row for each of the two."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"))
    return read_back(assemble(format_turns(turns))).drop("attachments")


# characters that the template adds: its marks, a backslash for each backslash
# and for each place where a control string starts
_CHAT_ADDED = " + ".join(
    ["length('<|start|><|message|><|end|>')", "length(role) + length(text)",
     "length(text) - length(replace(text, chr(92), ''))"]
    + [f"(length(text) - length(replace(text, '{c}', ''))) // {len(c)}" for c in ["<|", *CONTROL]])

OP3_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({_CHAT_ADDED})::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return top_k(vectors, F.col("id") % 50 == 0, k=5, scale=256.0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages"), min_bytes=0))


OP5_SQL = """
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS first_id FROM rows GROUP BY payload),
hexed AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS h, first_id FROM rows JOIN firsts USING (payload))
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM hexed
"""


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3, modulus=5, left_out=0)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7, modulus=3, left_out=1)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))


def op11_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"), shingle=4, percent=85)


OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS s FROM w
), sized AS (SELECT doc_id, len(s) AS n, s FROM sets
), tokens AS (SELECT doc_id, n, unnest(s) AS t FROM sized
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 185 * count(*) >= 85 * (a.n + b.n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized UNION SELECT r.doc_id, p.b FROM reach r JOIN pairs p ON p.a = r.other
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(other) AS component_id FROM reach JOIN sized USING (doc_id) GROUP BY doc_id
"""


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.transform(table(spark, sf_dir, "documents"), salt="1", plain_from=90, spm_below=20))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


OP12_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
    ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4 FROM t
), cut AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), made AS (
  SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, b - a) AS m, substring(text, b + 1) AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM made
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), longest=4, least=30, scale=2_000_000, covered=80, top=2000)


OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang
), started AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM split
), grams AS (SELECT lang, ws[i:i + k - 1] AS p, k FROM started, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)
), f AS (SELECT lang, p, k, count(*) AS c FROM grams GROUP BY lang, p, k HAVING count(*) >= 30
), cuts AS (
  SELECT x.lang, x.p, x.c AS a, cut, l.c AS l, r.c AS r, 2000000::HUGEINT * x.c // (l.c + r.c) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) x
  JOIN f l ON l.lang = x.lang AND l.p = x.p[1:cut] JOIN f r ON r.lang = x.lang AND r.p = x.p[cut + 1:x.k]
), weakest AS (
  SELECT lang, p, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS o FROM cuts) WHERE o = 1
), inside AS (
  SELECT lang, p[i:i + m - 1] AS q, max(c) AS longer FROM f, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), stay AS (
  SELECT w.*, array_to_string(w.p, ' ') AS phrase FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.q = w.p
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * w.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM stay
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


QUERIES = {
    "op1_decontam": op1_decontam,
    "op2_simhash": op2_simhash,
    "op3_chat": op3_chat,
    "op4_topk": op4_topk,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_html": op7_html,
    "op8_bpe": op8_bpe,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_setjoin": op11_setjoin,
    "op12_fim": op12_fim,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_chat": OP3_SQL,
    "op4_topk": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op11_setjoin": OP11_SQL,
    "op12_fim": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
