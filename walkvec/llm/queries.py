"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from walkvec.llm import (
    decontaminate,
    hard_negatives,
    importance,
    link_trust,
    mixing,
    packing,
    pseudo_likelihood,
    quality_model,
    quality_rules,
    repeats,
    secret_scan,
    sharding,
    shingle_join,
)
from walkvec.llm.common import table


def op1_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judged_pages(table(spark, sf_dir, "pages"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.scored_documents(table(spark, sf_dir, "documents"))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents"))


def op7_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged_documents(table(spark, sf_dir, "documents"))


def op8_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


def op10_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_coordinate_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.shifted_labels(table(spark, sf_dir, "embeddings")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digested(packing.packed(table(spark, sf_dir, "documents")))


OPERATORS = (
    op1_trigram_secrets,
    op2_entropy_mixing,
    op3_shingle_join,
    op4_link_trust,
    op5_pseudo_likelihood,
    op6_hilbert_sharding,
    op7_rule_ledger,
    op8_boosted_quality,
    op9_suffix_family,
    op10_winnowing_decontamination,
    op11_coordinate_negatives,
    op12_importance_resampling,
    op13_vector_packing,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def statements() -> dict[str, str]:
    return {
        "op3_shingle_join": shingle_join.COMPONENT_SQL,
        "op7_rule_ledger": quality_rules.RULES_SQL,
        "op10_winnowing_decontamination": decontaminate.CONTAMINATION_SQL,
        "op11_coordinate_negatives": hard_negatives.NEGATIVES_SQL,
    }
