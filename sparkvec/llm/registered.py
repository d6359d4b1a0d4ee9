"""The queries of this subpackage, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkvec.llm import (
    ann,
    decontaminate,
    filter_audit,
    langid,
    line_dedup,
    mixing,
    oracles,
    paragraph_dedup,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from sparkvec.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op1_sharding": oracles.SHARDING,
    "op2_suffix_array_dedup": oracles.SUFFIX_DEDUP,
    "op3_decontamination": decontaminate.ORACLE,
    "op5_ann_hilbert": oracles.ANN,
    "op6_mixing": mixing.ORACLE,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark, sf_dir):
    return sharding.assignment(table(spark, sf_dir, "documents"))


@query
def op2_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_quality_classifier(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_ann_hilbert(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"))


@query
def op6_mixing(spark, sf_dir):
    return mixing.shares(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark, sf_dir):
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op8_paragraph_minhash(spark, sf_dir):
    return paragraph_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op9_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op10_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_vector_codes(spark, sf_dir):
    return vector_codes.digest(table(spark, sf_dir, "embeddings"))


@query
def op13_toxicity(spark, sf_dir):
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
