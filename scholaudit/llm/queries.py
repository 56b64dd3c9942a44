"""Registered queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scholaudit.llm import (
    block_ranking,
    bloom_dedup,
    bond_negatives,
    bpe,
    co_training,
    html_wrappers,
    jaccard_join,
    mixing,
    pseudo_likelihood,
    quality_rules,
    suffix_dedup,
    toxicity,
    url_language_model,
)
from scholaudit.llm.shared import read_table

BPE_FILE = "byte_bpe_50k.json"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "documents")


def op1_html_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return html_wrappers.extract_pages(read_table(spark, folder, "pages"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rule_report(documents(spark, folder))


def op3_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.score_documents(documents(spark, folder))


def op4_url_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return url_language_model.judge_urls(read_table(spark, folder, "pages"), url_language_model.RULES)


def op5_co_training(spark: SparkSession, folder: str) -> DataFrame:
    return co_training.classify(documents(spark, folder), read_table(spark, folder, "labels"))


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.token_digests(documents(spark, folder), public_tokenizers.path(BPE_FILE))


def op7_bloom_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_dedup.duplicate_groups(documents(spark, folder))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.link_components(documents(spark, folder))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.repeated_substrings(documents(spark, folder))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_schedule(documents(spark, folder), max_repetition=2.0)


def op11_toxicity_gru(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(documents(spark, folder), read_table(spark, folder, "labels"))


def op12_block_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return block_ranking.rank_documents(documents(spark, folder), read_table(spark, folder, "benchmark"))


def op13_bond_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return bond_negatives.hard_negatives(read_table(spark, folder, "embeddings"))


QUERIES = {
    "op1_html_wrappers": op1_html_wrappers,
    "op2_quality_rules": op2_quality_rules,
    "op3_pseudo_likelihood": op3_pseudo_likelihood,
    "op4_url_language_model": op4_url_language_model,
    "op5_co_training": op5_co_training,
    "op6_bpe": op6_bpe,
    "op7_bloom_dedup": op7_bloom_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_mixing": op10_mixing,
    "op11_toxicity_gru": op11_toxicity_gru,
    "op12_block_ranking": op12_block_ranking,
    "op13_bond_negatives": op13_bond_negatives,
}

_EXACT_COPIES = r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS size,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
), placed AS (
    SELECT doc_id, body,
        first_value(doc_id) OVER (PARTITION BY body ORDER BY size DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size
    FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM placed
"""

_TERMS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

_RANKED = f"""
WITH texts AS (
    SELECT doc_id, {_TERMS} AS terms FROM documents
), totals AS (
    SELECT count(*) AS docs, sum(len(terms)) AS words FROM texts WHERE len(terms) > 0
), uses AS (
    SELECT doc_id, size, term, count(*) AS tf
    FROM (SELECT doc_id, len(terms) AS size, unnest(terms) AS term FROM texts)
    GROUP BY doc_id, size, term
), asked AS (
    SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
    FROM uses, totals GROUP BY term
), scores AS (
    SELECT item_id, doc_id,
        CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * docs) // words)))) AS BIGINT) AS score
    FROM asked JOIN uses USING (term) JOIN weights USING (term), totals
    GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10
"""

_NEGATIVES = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, v.vec_id, v.label,
        CAST(list_inner_product(a.parts, v.parts) AS BIGINT) AS score
    FROM vectors a, vectors v WHERE a.vec_id % 100 = 0 AND v.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# Of the others, 1, 2, 4, 6 and 8 to 10 need trees, sets of words, models, merges or byte strings
# at every place, which SQL can't say within reason, and 3, 5 and 11 are trained.
ORACLE_SQL: dict[str, str] = {
    "op7_bloom_dedup": _EXACT_COPIES,
    "op12_block_ranking": _RANKED,
    "op13_bond_negatives": _NEGATIVES,
}
