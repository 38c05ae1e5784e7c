"""One query per operator over its whole table, in the form its contract fixes, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattsift.llm.chat import repair_conversations
from wattsift.llm.decontaminate import ORACLE as DECONTAMINATE_SQL
from wattsift.llm.decontaminate import benchmark_matches, hit_words, is_contaminated
from wattsift.llm.html_text import extract_main_text
from wattsift.llm.language import fit_languages, fold, predict_languages
from wattsift.llm.likelihood import score_texts
from wattsift.llm.merkle import ORACLE as MERKLE_SQL
from wattsift.llm.merkle import edit_fingerprints
from wattsift.llm.near_dup import near_duplicates
from wattsift.llm.one_bit import ORACLE as ONE_BIT_SQL
from wattsift.llm.one_bit import nearest_by_codes
from wattsift.llm.packing import pack_documents
from wattsift.llm.secrets import BASE_KINDS, find_secrets, joined_spans
from wattsift.llm.spelling import ORACLE as SPELLING_SQL
from wattsift.llm.spelling import spelling_variants
from wattsift.llm.value_codes import ORACLE as VALUE_CODES_SQL
from wattsift.llm.value_codes import books_digest, product_codes
from wattsift.llm.warc_zip import ORACLE as WARC_SQL
from wattsift.llm.warc_zip import round_trip


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    base = F.sha2(joined_spans(F.col("spans"), BASE_KINDS), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, joined_spans(F.col("spans")).alias("spans"))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(table(spark, sf_dir, "conversations"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = predict_languages(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op9_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, fold(F.col("doc_id"), 10) == 0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(F.col("hits"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated(F.col("n_words"), n_hit).alias("contaminated"),
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_value_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(table(spark, sf_dir, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(books_digest(books)))


def op13_one_bit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_by_codes(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_warc_zip": op4_warc_zip,
    "op5_html_text": op5_html_text,
    "op6_merkle": op6_merkle,
    "op7_chat": op7_chat,
    "op8_language": op8_language,
    "op9_likelihood": op9_likelihood,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling": op11_spelling,
    "op12_value_codes": op12_value_codes,
    "op13_one_bit": op13_one_bit,
}

ORACLES: dict[str, str] = {
    "op4_warc_zip": WARC_SQL,
    "op6_merkle": MERKLE_SQL,
    "op10_decontaminate": DECONTAMINATE_SQL,
    "op11_spelling": SPELLING_SQL,
    "op12_value_codes": VALUE_CODES_SQL,
    "op13_one_bit": ONE_BIT_SQL,
}
