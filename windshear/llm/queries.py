"""The registered queries ``opN_<name>``: each applies its operator to its whole
table with production parameters and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windshear.llm import (alignment, hyperminhash, imatch, langid, mixing, negatives, pii, secrets, suffixes, templates,
                            toxicity, transducer, warc)
from windshear.llm.common import held_out, read_table


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and of its edited text."""
    return imatch.fingerprints(read_table(spark, sf_dir, "documents"))


def op2_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document at source weights 5, 2, 1 and 150 % of all words."""
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op3_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back along the verified record chains."""
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op4_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; counts are over all spans, plain and disguised."""
    out = pii.find(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


def op5_forest_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of all documents with the forest's verdict."""
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at 100 * intersection >= 85 * union on five-word shingles."""
    return hyperminhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=5, percent=85)


def op7_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, site templates removed."""
    return templates.extract(read_table(spark, sf_dir, "pages"))


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_words", "segments")


def op9_word_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document, and its longest verbatim match."""
    out = suffixes.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_at", "longest_item")


def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row's positives, out of all rows."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding")
    return negatives.mine(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


def op12_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with the word vocabulary, and decoded again."""
    return transducer.code(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and piece tokens of every document aligned, with corpus-wide counts of linked pairs."""
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_imatch": op1_imatch,
    "op2_entropy_mixing": op2_entropy_mixing,
    "op3_boundary_chain": op3_boundary_chain,
    "op4_deobfuscated_pii": op4_deobfuscated_pii,
    "op5_forest_secrets": op5_forest_secrets,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_site_templates": op7_site_templates,
    "op8_toxic_segments": op8_toxic_segments,
    "op9_word_backoff": op9_word_backoff,
    "op10_suffix_arrays": op10_suffix_arrays,
    "op11_cover_tree_negatives": op11_cover_tree_negatives,
    "op12_transducer_bpe": op12_transducer_bpe,
    "op13_token_alignment": op13_token_alignment,
}

# SQL for the queries that it can express.
ORACLE: dict[str, str] = {
    "op3_boundary_chain": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
        f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to, TRUE AS digest_ok
        FROM p LEFT JOIN f USING (digest)""",
    "op11_cover_tree_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10""",
}
