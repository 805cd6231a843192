"""The registered queries ``opN_<name>`` and ``pipeline`` of this subpackage,
with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (bit_sliced_topk, collocations, edit_embedding, importance, jaccard_join, label_shards, license_scan, mixing, page_text, piece_bpe,
               quality_rules, suffix_dedup, url_filters)
from .common import table


def model_file(name: str = "piece_bpe_32k.model") -> str:
    """Place of a public vocabulary file (a parameter of the operator)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages"), url_filters.rule_table(spark))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(table(spark, sf_dir, "documents"), model_file())


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced_topk.top_k(table(spark, sf_dir, "embeddings"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_shards.shard_documents(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_embedding.fingerprints(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filters": op1,
    "op2_suffix_dedup": op2,
    "op3_html_text": op3,
    "op4_entropy_mix": op4,
    "op5_license_scan": op5,
    "op6_sentencepiece": op6,
    "op7_quality_rules": op7,
    "op8_bit_sliced_topk": op8,
    "op9_label_shards": op9,
    "op10_jaccard_join": op10,
    "op11_edit_fingerprints": op11,
    "op12_importance_resample": op12,
    "op13_collocations": op13,
}

SQL = {
    "op1_url_filters": url_filters.SQL,
    "op2_suffix_dedup": suffix_dedup.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op8_bit_sliced_topk": bit_sliced_topk.SQL,
    "op10_jaccard_join": jaccard_join.SQL,
    "op12_importance_resample": importance.SQL,
    "op13_collocations": collocations.SQL,
}
