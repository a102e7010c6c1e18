"""The training-text pipeline: stages over ``documents``, each written and read again by the next.

Quality, near-duplicates and decontamination drop rows (and decontamination
cuts short copied passages out of the rest), personal data is replaced by its
kind, and what is left is encoded and decoded. All but the last stage return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinolens.llm.common import arrow_rows, documents, stored
from kinolens.llm.decontaminate import decontaminate
from kinolens.llm.near_copies import keep_first_copy
from kinolens.llm.pii import redact
from kinolens.llm.quality import keep_quality
from kinolens.llm.sentencepiece_codec import encode_documents
from kinolens.llm.simhash import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, by the rule of operator 6."""
    return keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: first by fingerprints, then by exact five-word similarity."""
    with arrow_rows(spark, 1000):
        return keep_first_copy(stored(near_duplicates(spark, docs, sf_dir), "near-fingerprints"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those contaminated by the benchmark; copied passages are cut from the others."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded."""
    return encode_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", encoding),
]

#: SQL can't express a fitted classifier; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
