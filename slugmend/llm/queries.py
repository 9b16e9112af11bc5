"""Registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from slugmend.llm import (
    byte_bpe,
    collocations,
    html_extract,
    licenses,
    line_dedup,
    lsh_forest,
    mixing,
    quality,
    simhash,
    spelling,
    token_count,
    topk,
    toxicity,
)
from slugmend.llm.common import table

#: Vocabulary files; any other file of the same kind will do.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, d, "pages"))


def op2_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.line_quality(table(spark, d, "documents"))


def op3_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_count.count_documents(table(spark, d, "documents"), PIECE_BPE)


def op4_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, d, "documents"), BYTE_BPE)


def op5_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"))


def op6_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.link_documents(table(spark, d, "documents"))


def op7_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.top_k(table(spark, d, "embeddings"))


def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, d, "labels")))


def op9_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.decide_lines(table(spark, d, "documents"))


def op10_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_documents(table(spark, d, "documents"))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, d, "documents"))


def op12_lsh_forest(spark: SparkSession, d: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, d, "documents"))


def op13_spelling(spark: SparkSession, d: str) -> DataFrame:
    return spelling.group_variants(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_quality_rules": op2_quality_rules,
    "op3_token_counts": op3_token_counts,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_topk": op7_topk,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_licenses": op10_licenses,
    "op11_collocations": op11_collocations,
    "op12_lsh_forest": op12_lsh_forest,
    "op13_spelling": op13_spelling,
}
