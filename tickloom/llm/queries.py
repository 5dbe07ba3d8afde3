"""The registered queries of the text operators. Each applies its operator, with production settings, to its whole
table and derives the published columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    backoff,
    chat,
    collocations,
    decontamination,
    html_text,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    sharding,
    substring_dedup,
    toxicity,
    whitening,
)
from .oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    out = decontamination.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages"))


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out = backoff.scored(table(spark, folder, "documents"))
    # the order of a sum shows in the last digits
    return out.select("doc_id", "n_words", *(F.round(c, 4).alias(c) for c in ("log_score", "mean_log_score")))


@query
def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.repeated_spans(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


@query
def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), near_dedup.Similarity(percent=85))


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.calibrated(table(spark, folder, "documents"))


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.counted(table(spark, folder, "documents"))


@query
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit(r"\### Assistant: </turn> ok")
    added = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    out = chat.digests(chat.conversations_formatted(rows.unionByName(added)))
    digests = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return out.select(*digests, F.col("order_error").isNull().alias("in_order"))


@query
def op11_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.component_rows(table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    out = sharding.placed(table(spark, folder, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
