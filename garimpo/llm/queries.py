"""The corpus queries, one for each operator, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from garimpo.llm import collocations, conversations, exact_dedup, jaccard_join, langid, licenses, mixing, packing, pii, quality, repeats, topk, warc
from garimpo.llm.common import read


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(read(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op2_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op9_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(read(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.kept_texts(read(spark, sf_dir, "documents"))).drop("kept_text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(read(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


OPERATORS = (
    op1_ngram_jaccard_join,
    op2_weighted_mix,
    op3_importance_resampling,
    op4_exact_topk,
    op5_best_fit_packing,
    op6_weak_supervision_pii,
    op7_license_scan,
    op8_exact_dedup,
    op9_crf_language_id,
    op10_suffix_array_dedup,
    op11_conversation_repair,
    op12_phrase_collocations,
    op13_warc_transactions,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_weighted_mix": mixing.ORACLE,
        "op4_exact_topk": topk.ORACLE,
        "op7_license_scan": licenses.oracle(),
        "op11_conversation_repair": conversations.oracle(),
        "op12_phrase_collocations": collocations.ORACLE,
        "op13_warc_transactions": warc.ORACLE,
        "op8_exact_dedup": r"""
            WITH n AS (
              SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
            SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
            FROM n WINDOW w AS (PARTITION BY norm)
        """,
    }
