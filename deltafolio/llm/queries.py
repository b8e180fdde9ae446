"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, compression_classifier, licenses, matroska, ngram_join, packing, pii, quality, secret_scan, token_counts, vector_codes, warc, whitening
from .common import reads, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.components(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), keep_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents"))
    return reads(found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_discovered"), found)


def op8_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    rows = warc.read(warc.write(pages))
    return reads(rows.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")), rows)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op10_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.media(table(spark, sf_dir, "documents"), keep_media=False)


def op11_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_license_scan, op2_ngram_jaccard, op3_byte_bpe, op4_best_fit_packing, op5_secret_scan, op6_quality_rules, op7_pii, op8_warc_archive, op9_token_counts, op10_matroska, op11_compression_classifier, op12_vector_codes, op13_whitening)
}

_SQL: dict[str, str] = {
    "op8_warc_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, strlen(coalesce(html, '')) AS n FROM pages),
             f AS (SELECT d, min(page_id) AS first_id FROM p GROUP BY d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
               CASE WHEN n >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND page_id <> first_id THEN first_id END AS refers_to
        FROM p JOIN f USING (d)
    """,
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
