"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from registry.scratch import with_scratch
from tidemark.llm import (chat, decontaminate, hard_negatives, kneser_ney, licenses, manifest,
                          mixing, oracle, pii, pitman_yor, quality_rules, secrets,
                          sentence_pieces, simhash)
from tidemark.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(read_table(spark, folder, "documents"))


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, folder, "documents"),
                                      read_table(spark, folder, "benchmark"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.judged(read_table(spark, folder, "documents"),
                             read_table(spark, folder, "labels"))


def _chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings of other templates."""
    extra = spark.sql("""
        SELECT bigint(-1) AS conv_id, bigint(turn) AS turn, role, '</s>[INST] ok [/INST]' AS text
        FROM VALUES (0, 'user'), (1, 'assistant') AS turns(turn, role)""")
    told = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.transcript_digests(chat.chat_transcripts(told.unionByName(extra)))


def _sentence_pieces(docs: DataFrame) -> DataFrame:
    return sentence_pieces.encoding_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


def _hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.relabelled(read_table(spark, folder, "embeddings"), 7, 10)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def _manifest(docs: DataFrame) -> DataFrame:
    return manifest.manifest(docs, manifest.tampered_by_crc())


def all_queries() -> dict[str, Query]:
    queries = {
        "op1_host_rules": _over_documents(quality_rules.judged),
        "op2_pitman_yor": _over_documents(pitman_yor.document_scores),
        "op3_decontamination": _decontamination,
        "op4_kneser_ney": _quality,
        "op5_license_scan": _over_documents(licenses.license_scan),
        "op6_pii": _over_documents(pii.find_pii),
        "op7_mixing": _over_documents(mixing.mixture),
        "op8_simhash": _over_documents(simhash.near_duplicates),
        "op9_secret_scan": _over_documents(secrets.secret_spans),
        "op10_chat": _chat,
        "op11_sentence_pieces": _over_documents(_sentence_pieces),
        "op12_hard_negatives": _hard_negatives,
        "op13_manifest": _over_documents(_manifest),
        "pipeline": corpus_pipeline.run,
    }
    return {name: with_scratch(query) for name, query in queries.items()}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.TEXTS)
