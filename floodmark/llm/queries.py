"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, chat, decontamination, exact_dedup, fingerprints, hard_negatives, mixing, packing, quality, secrets, shingle_join, token_counts, warc
from .common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), spare=0.0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("bucket", "text_hash")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_documents(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).drop("segments", "error", "record_id")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives.mine_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict:
    ops = (
        op1_secret_scans, op2_token_counts, op3_mixing, op4_quality_classifier, op5_chat_formatting,
        op6_exact_dedup, op7_jaccard_join, op8_best_fit_packing, op9_warc, op10_fingerprints,
        op11_decontamination, op12_hard_negatives, op13_token_alignment,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_mixing": mixing.ORACLE,
        "op5_chat_formatting": chat.ORACLE,
        "op6_exact_dedup": exact_dedup.ORACLE,
        "op9_warc": warc.ORACLE,
        "op11_decontamination": decontamination.ORACLE,
        "op12_hard_negatives": hard_negatives.ORACLE,
    }
