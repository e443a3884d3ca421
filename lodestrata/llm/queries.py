"""The contract queries: each operator over its whole table, results as digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest_neighbours
from .byte_bpe import encode, read_ranks
from .common import remainder, sha256_hex, table
from .fingerprints import document_fingerprints
from .line_dedup import line_dedup
from .maxent_lm import lm_scores
from .packing import pack_documents
from .quality import quality_scores
from .simhash import simhash_components
from .substring_dedup import substring_dedup
from .url_filters import url_filter


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lm_scores(_documents(spark, sf_dir))
    return done.select(
        F.col("_id").alias("doc_id"), F.col("_held_out").alias("held_out"), F.col("_n_tokens").alias("n_tokens"), F.col("_n_known").alias("n_known"),
        F.col("_train_tokens").alias("train_tokens"), F.col("_base_score").alias("base_score"), F.col("_score").alias("score"),
    )


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(_documents(spark, sf_dir))
    return found.select(F.col("_id").alias("doc_id"), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), F.col("_component").alias("component_id"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = encode(_documents(spark, sf_dir), read_ranks(_vocabulary("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    return done.select("doc_id", (F.length("_ids") / 4).cast("long").alias("n_tokens"), sha256_hex(F.col("_ids")).alias("ids_sha256"), sha256_hex(F.col("_decoded")).alias("decoded_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(_documents(spark, sf_dir), counts=("n_lines", "n_dropped"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(_documents(spark, sf_dir), count=True)
    return kept.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), sha256_hex(F.col("text")).alias("kept_sha256"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = document_fingerprints(_documents(spark, sf_dir), names=("n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
    return out.select("doc_id", "n_chars", sha256_hex(F.col("edited")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = pack_documents(_documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"))
    return places.select(F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_lm_scoring, op2_simhash_near_dedup, op3_nearest_neighbours, op4_byte_bpe, op5_line_dedup, op6_substring_dedup, op7_document_fingerprints, op8_best_fit_packing, op9_quality_classifier, op10_url_filters)
}
