"""A training corpus from ``documents``, in five stages; each is written as Parquet and read again by the next.

Known languages only, one document of each group of near-duplicates, no benchmark passages, no secrets, packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wattsift.llm.decontaminate import remove_contaminated
from wattsift.llm.language import fit_languages, keep_known
from wattsift.llm.near_dup import keep_one
from wattsift.llm.packing import pack_documents
from wattsift.llm.secrets import redact_secrets
from wattsift.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near a centroid of some language; learned from the documents that name theirs."""
    return keep_known(docs, fit_languages(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of every group of near-duplicates."""
    return keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    return redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # tokenizers and fitted classifiers are not in SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
