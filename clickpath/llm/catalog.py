"""Registered queries of the corpus operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpath.llm.common import table
from clickpath.llm.decontaminate import contamination_report
from clickpath.llm.hard_negatives import mining_report
from clickpath.llm.hash_forest import neighbours_report
from clickpath.llm.jaccard_join import near_duplicates
from clickpath.llm.line_rules import quality_rules_report
from clickpath.llm.mixing import mixing_report
from clickpath.llm.oracles import ORACLE_SQL  # noqa: F401 - read by the entry file
from clickpath.llm.personal_data import personal_data_report
from clickpath.llm.quality import quality_report
from clickpath.llm.repeats import repeats_report
from clickpath.llm.suffix_dedup import suffix_report
from clickpath.llm.toxicity import toxicity_report
from clickpath.llm.warc import archive_report
from clickpath.llm.whitening import whitening_report


#: payload bytes per archive shard (one sorted task and at least one file each)
WARC_SHARD_BYTES = 16 << 20


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours_report(table(spark, sf_dir, "embeddings"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(spark, table(spark, sf_dir, "pages"), shard_bytes=WARC_SHARD_BYTES)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_report(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening_report(table(spark, sf_dir, "embeddings"))


def op12_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules_report(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mining_report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_personal_data": op2_personal_data,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_hash_forest": op6_hash_forest,
    "op7_mixing": op7_mixing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_warc": op9_warc,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_whitening": op11_whitening,
    "op12_line_rules": op12_line_rules,
    "op13_hard_negatives": op13_hard_negatives,
}
