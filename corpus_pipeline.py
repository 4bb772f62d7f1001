"""Documents in, token ids out: toxicity, near-duplicates, personal data, source mix, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its predecessor kept.  All but the last return the
columns of ``documents``; the last returns the ids of each text in its place.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import byte_bpe, mixing, pii, simhash, toxicity
from tarmac.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; the model is fitted on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.keep_clean(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked at 2 differing fingerprint bits or fewer."""
    return simhash.keep_one(docs, words=3)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced by the kind in brackets and ``n_chars`` counted anew."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, as ``ids``."""
    return byte_bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: SQL can express neither the classifier nor the encoder; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each writes its rows as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
