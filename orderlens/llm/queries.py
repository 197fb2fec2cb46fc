"""One registered query per operator, over its whole table, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (chat, decontaminate, hard_negatives, licenses, main_text, mixing, near_dedup, quality_cnn, quality_rules, sharding,
               substring_dedup, warc, whitening)
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.edits(table(spark, sf_dir, "documents", "doc_id", "text"), unit="clause")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                                table(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), number % 100 == 0, label=label)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_licenses": op2_licenses,
    "op3_main_text": op3_main_text,
    "op4_mixing": op4_mixing,
    "op5_chat": op5_chat,
    "op6_quality_rules": op6_quality_rules,
    "op7_sharding": op7_sharding,
    "op8_near_dedup": op8_near_dedup,
    "op9_quality_cnn": op9_quality_cnn,
    "op10_decontaminate": op10_decontaminate,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_warc": op13_warc,
}

SQL: dict[str, str] = {
    "op5_chat": chat.SQL,
    "op10_decontaminate": decontaminate.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
    "op13_warc": warc.SQL,
}
