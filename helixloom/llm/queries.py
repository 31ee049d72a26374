"""The opN queries over the synthetic tables, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixloom.llm import language_id, quality_pu, secret_scan
from helixloom.llm.bin_packing import pack_documents
from helixloom.llm.bpe_codec import codec_digests
from helixloom.llm.embedding_dedup import near_duplicate_vectors
from helixloom.llm.fingerprints import fingerprints
from helixloom.llm.lm_bloom import lm_scores
from helixloom.llm.minhash_dedup import near_duplicates
from helixloom.llm.token_counts import token_counts


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _remainder(modulus: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates of whole texts by three-word shingles at 0.85. Texts without words are linked with nothing, rows of one
    id are one node, an empty table gives an empty one (see ``near_duplicates``)."""
    return near_duplicates(_docs(spark, sf_dir), shingle_words=3, num=85, den=100)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of whole texts. Null and empty texts have zeros, rows are counted one by one, an empty table
    gives an empty one (see ``token_counts``)."""
    return token_counts(_docs(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of whole texts, learnt from the rows whose remainder isn't 2. Null texts and those without a letter are ``und``
    with score 0, a null id isn't held out, an empty table gives an empty one (see ``language_id.predict``)."""
    docs = _docs(spark, sf_dir)
    net = language_id.fit(docs, _remainder(4) != 2)
    return _with_held_out(language_id.predict(docs, net))


def _with_held_out(rows: DataFrame) -> DataFrame:
    return rows.withColumn("held_out", F.coalesce(_remainder(4) == 2, F.lit(False)))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded texts as digests. Null and empty texts have no tokens, rows are encoded one by one, an empty table
    gives an empty one (see ``codec_digests``)."""
    return codec_digests(_docs(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of whole texts, learnt from the rows whose remainder isn't 2. Null texts are scored like empty ones, a null id
    isn't held out, an empty table gives an empty one (see ``quality_pu.predict``)."""
    docs = _docs(spark, sf_dir)
    net = quality_pu.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), _remainder(4) != 2)
    return _with_held_out(quality_pu.predict(docs, net))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts. Null texts count as empty, rows without an id have no next
    document, an empty table gives an empty one (see ``fingerprints``)."""
    return fingerprints(_docs(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of whole texts. Null and empty texts have none, rows are scanned one by one, an empty table gives an empty one
    (see ``secret_spans``)."""
    docs = _docs(spark, sf_dir)
    return secret_scan.secret_spans(docs, secret_scan.fit(docs))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors within a label at 0.98. Vectors without a label or a direction are linked with nothing, an empty
    table gives an empty one (see ``near_duplicate_vectors``)."""
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens. Null and empty texts are their end token alone, every row is packed,
    an empty table gives an empty one (see ``pack_documents``)."""
    return pack_documents(_docs(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of whole texts, learnt from the rows whose remainder isn't 0. Null and empty texts are their end token
    alone, rows without an id are held out, an empty table gives an empty one (see ``lm_scores``)."""
    return lm_scores(_docs(spark, sf_dir), held_out=_remainder(10) == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_language_id": op3_language_id,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_secret_scan": op7_secret_scan,
    "op8_embedding_near_dedup": op8_embedding_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_lm_scoring": op10_lm_scoring,
}

#: Words and shingle sets of the contract, all pairs that share a shingle, and the components of the links.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingles
  FROM w
), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS both
  FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p
), r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN c ON s.doc_id = c.node
"""

#: All pairs of a label in double precision, and the components of the links.
OP8_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98
), r(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON r.seen = l.a
), c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT c.node AS vec_id, (SELECT count(*) FROM l WHERE l.a = c.node) AS n_links, c.component_id, c.node = c.component_id AS kept FROM c
"""

ORACLE_SQL: dict[str, str] = {"op1_minhash_near_dedup": OP1_SQL, "op8_embedding_near_dedup": OP8_SQL}
