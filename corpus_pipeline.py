"""The corpus pipeline: quality rules, two de-duplications, mixing, tokens.

Each stage takes all rows that the one before kept and returns rows with the
columns of documents; the last returns them as tokens. ``run`` writes every
stage to the shared folder and reads it again.

1. Quality rules: documents that fail are dropped, boilerplate lines are
   removed from the others, and ``n_chars`` follows.
2. Exact de-duplication: one row of each group of equal texts stays.
3. Near-duplicates: of documents whose sets of five-word shingles are linked by
   a similarity of 0.8 or more, the one with the smallest id stays.
4. Mixing: every document is used once; documents of small sources are repeated
   in whole passes and a part of one, up to twice as often as those of the
   largest, in blocks that hold each source's share.
5. Tokens: ids of the byte-level BPE, with their number and the check that they
   decode to the text.

Nulls, empty texts, repeated rows and empty tables are treated as the
operators state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholaudit.llm import bloom_dedup, bpe, jaccard_join, mixing, quality_rules
from scholaudit.llm.shared import read_table, ship_package, stage

BPE_FILE = "byte_bpe_50k.json"
MAX_REPETITION = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kept = quality_rules.apply_rules(docs)
    kind = docs.schema["n_chars"].dataType
    return kept.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bloom_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.one_per_component(docs, size=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, max_repetition=MAX_REPETITION)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    encoded = bpe.encode(docs, public_tokenizers.path(BPE_FILE))
    return encoded.select(
        "doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip"
    )


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# Shingle sets, hashes of lines and BPE merges have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
