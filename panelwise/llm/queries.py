"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .filter_audit import audit_documents, audit_sql
from .fingerprints import fingerprints, near_duplicates
from .licenses import known_licenses, license_scan, scan_sql
from .lm_scoring import score_documents
from .mixing import mixed
from .neighbours import nearest
from .ngram_join import ngram_jaccard_join
from .packing import pack
from .periodic_runs import periodic_runs, run_digests, with_planted_runs
from .quality import classify_quality
from .sharding import shard_documents
from .substring_dedup import substring_dedup
from .url_filters import PAGE_RULES, filter_sql, filter_urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_read(spark, sf_dir, "documents"), n=3, percent=90)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # The same vocabulary and ids as byte_bpe_50k.json, read by the faster of the two libraries; tests compare them.
    return pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_read(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_read(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_read(spark, sf_dir, "documents"), known_licenses(spark))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_read(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = "crc32(cast(doc_id as string)) % 7"
    scored = score_documents(_read(spark, sf_dir, "documents"), f"{part} <> 2")
    return scored.select("doc_id", F.expr(f"coalesce({part} = 2, false)").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(_read(spark, sf_dir, "documents"))))


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(PAGE_RULES, "host string, path string, verdict string")
    return filter_urls(_read(spark, sf_dir, "pages"), rules)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def fingerprint_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other half of operator 4: documents joined by bands of their signatures, with Jaccard verified on whole sets."""
    return near_duplicates(_read(spark, sf_dir, "documents"))


_OPERATORS = (
    op1_ngram_jaccard_join, op2_nearest_neighbours, op3_mixing_sources, op4_document_fingerprints, op5_lm_scoring,
    op6_substring_dedup, op7_license_scan, op8_sharding, op9_packing, op10_quality_classifier, op11_periodic_runs, op12_url_filters,
    op13_filter_audit, fingerprint_clusters,
)
QUERIES = {f.__name__: f for f in _OPERATORS}
ORACLE_SQL: dict[str, str] = {"op7_license_scan": scan_sql(), "op12_url_filters": filter_sql(), "op13_filter_audit": audit_sql()}
