"""One query per operator with production parameters, over whole tables, and the DuckDB statements they equal."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from evenhand.llm import (
    bpe, filter_audit, jaccard, language, licenses, mixing, nearvectors, quality, shards, suffixes, token_files, tree_bpe, whitening,
)
from evenhand.llm.common import documents
from evenhand.llm.statements import FILTERS_SQL, LICENSES_SQL, MIXING_SQL


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.predict(docs, language.fit(docs))


def op4_pigeonhole_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_token_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op6_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed(documents(spark, sf_dir))


def op7_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(documents(spark, sf_dir))


def op9_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op12_filter_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_incremental_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_prefix_bpe": op2_prefix_bpe,
    "op3_language": op3_language,
    "op4_pigeonhole_blocks": op4_pigeonhole_blocks,
    "op5_token_combinations": op5_token_combinations,
    "op6_repeated_passages": op6_repeated_passages,
    "op7_pareto_mix": op7_pareto_mix,
    "op8_kd_shards": op8_kd_shards,
    "op9_fertility": op9_fertility,
    "op10_license_digests": op10_license_digests,
    "op11_tree_bpe": op11_tree_bpe,
    "op12_filter_diagrams": op12_filter_diagrams,
    "op13_incremental_whitening": op13_incremental_whitening,
}

ORACLES = {
    "op7_pareto_mix": MIXING_SQL,
    "op10_license_digests": LICENSES_SQL,
    "op12_filter_diagrams": FILTERS_SQL,
}
