"""The registered queries of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curbflow.llm import (
    ann_search, byte_bpe, centroid_clusters, decontamination, language_id, license_scan, near_dedup, packing, quality_rules, token_counts, toxicity,
    vector_codes, warc_fixity,
)
from curbflow.llm.common import table


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), token_counts.byte_level_vocabulary())


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_of_documents(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.licenses(table(spark, folder, "documents"))


def op3_warc_fixity(spark: SparkSession, folder: str) -> DataFrame:
    return warc_fixity.audit_of_pages(table(spark, folder, "pages"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_of_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_of_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_ann_search(spark: SparkSession, folder: str) -> DataFrame:
    return ann_search.neighbours(table(spark, folder, "embeddings"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_documents(table(spark, folder, "documents"), packing.word_vocabulary())


def op11_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters.clusters(table(spark, folder, "embeddings"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.codes(table(spark, folder, "embeddings"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoded_documents(table(spark, folder, "documents"), byte_bpe.multilingual_ranks())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_warc_fixity": op3_warc_fixity,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_ann_search": op8_ann_search,
    "op9_near_dedup": op9_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op6_token_counts": op6_token_counts,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_vector_codes": op12_vector_codes,
    "op13_byte_bpe": op13_byte_bpe,
}
ORACLES: dict[str, str] = {
    "op3_warc_fixity": warc_fixity.ORACLE,
    "op7_decontamination": decontamination.ORACLE,
    "op11_centroid_clusters": centroid_clusters.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
