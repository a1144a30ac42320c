"""The ``opN`` queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipcatalog.llm import (
    collocations, fingerprints, language_id, minmax_dedup, packing_plan, quality_bayes, ranked_search, secrets, suffix_dedup,
    tiling_decontam, token_output, toxic_neighbours, vector_dedup,
)
from clipcatalog.llm.common import table


def op1_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax_dedup.near_duplicates(table(spark, folder, "documents"))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, folder, "documents")))


def op3_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output.digest(token_output.packed_sequences(table(spark, folder, "documents")))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"))


def op6_tiling_decontam(spark: SparkSession, folder: str) -> DataFrame:
    return tiling_decontam.digest(
        tiling_decontam.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.held_out_languages(table(spark, folder, "documents"))


def op8_toxic_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return toxic_neighbours.held_out_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_packing_plan(spark: SparkSession, folder: str) -> DataFrame:
    return packing_plan.packed_documents(table(spark, folder, "documents"))


def op10_quality_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return quality_bayes.document_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_minmax_dedup, op2_secrets, op3_token_output, op4_suffix_dedup, op5_vector_dedup, op6_tiling_decontam,
        op7_language_id, op8_toxic_neighbours, op9_packing_plan, op10_quality_bayes, op11_collocations,
        op12_fingerprints, op13_ranked_search,
    )
}
ORACLES: dict[str, str] = {
    "op11_collocations": collocations.ORACLE, "op13_ranked_search": ranked_search.ORACLE,
}
