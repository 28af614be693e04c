"""Queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veilmark.llm import (
    byte_bpe,
    check_sql,
    class_lm,
    filter_audit,
    license_scan,
    merkle_manifest,
    mixing,
    ngram_join,
    ordinal_toxicity,
    order_minhash,
    pii,
    quality,
    sharding,
    token_store,
)
from veilmark.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def over_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(documents(spark, sf_dir))


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal_toxicity.document_toxicity(documents(spark, sf_dir), labels)


def registered() -> dict[str, Query]:
    return {
        "op1_ngram_join": over_documents(ngram_join.document_components),
        "op2_token_store": over_documents(token_store.stored_tokens),
        "op3_sharding": over_documents(sharding.sharded_documents),
        "op4_quality_rules": over_documents(quality.document_quality),
        "op5_class_lm": over_documents(class_lm.scored),
        "op6_ordinal_toxicity": _toxicity,
        "op7_order_minhash": over_documents(order_minhash.fingerprinted),
        "op8_byte_bpe": over_documents(byte_bpe.document_tokens),
        "op9_char_pii": over_documents(pii.document_pii),
        "op10_source_mixing": over_documents(mixing.mixed_documents),
        "op11_license_scan": over_documents(license_scan.document_licenses),
        "op12_filter_audit": filter_audit.filter_audit,
        "op13_merkle_manifest": over_documents(merkle_manifest.document_manifest),
    }


def checks() -> dict[str, str]:
    return check_sql.checks()
