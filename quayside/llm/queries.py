"""The registered queries of the operators here: whole tables in, the columns of their contracts out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    collocations,
    conversation_repair,
    line_rules,
    mixing,
    multi_index,
    packing,
    quality,
    secret_scan,
    simhash,
    tag_paths,
    token_counts,
    toxicity,
    url_filters,
)
from quayside.llm.words import table
from quayside.session import importable

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def remainder(key: str, divisor: int) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, radius=4)


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_rules.judge_lines(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *base, "base_failed", "kept")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 3) == 1)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(), limit=512)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) == 0)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=2048)


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")), copies="copies")


def op12_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_paths.extract(table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


QUERIES = (
    op1_url_filters,
    op2_simhash,
    op3_line_rules,
    op4_quality,
    op5_secrets,
    op6_token_counts,
    op7_mixing,
    op8_toxicity,
    op9_packing,
    op10_multi_index,
    op11_conversation_repair,
    op12_tag_paths,
    op13_collocations,
)


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {query.__name__: _ready(query) for query in QUERIES}
