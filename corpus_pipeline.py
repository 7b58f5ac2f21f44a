"""Training-corpus pipeline over ``documents``: five stages, each calling one operator of ``farebox.llm``.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps (the
last: token ids).  ``run`` writes every stage's result to the shared
checkpoint folder and reads it back as the next stage's input.
"""

from __future__ import annotations

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession

from farebox.llm import bpe, mixing, secrets, simhash, toxicity
from farebox.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    return toxicity.reject(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.deduplicate(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by their fitted rates."""
    return mixing.resample(docs, table(spark, sf_dir, "labels"))


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return bpe.encode(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("mixing", mix_to_targets),
    ("byte_bpe", encode_ids),
]

# The stages score text, hash shingles and merge bytes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
