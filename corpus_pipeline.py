"""A corpus from raw documents: quality rules, line dedup, near-dedup, decontamination, mixing.

Every stage gets what its predecessor kept, written as Parquet and read again, and all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import decontamination, line_dedup, mixing, near_dedup, quality
from tickloom.llm.common import WHITE_CHARS, clear_of
from tickloom.llm.oracle import PIPELINE as ORACLE_SQL
from tickloom.session import stage

__all__ = ["ORACLE_SQL", "STAGES", "run"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep_good(docs)


def line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks and passages of lines that stand earlier in the corpus. A document of which no word
    is left goes; ``n_chars`` counts what is left. Null texts stay, rows with equal id and text keep the same lines."""
    (cut,) = clear_of(docs, "cut")  # the column that without_repeats adds
    out = line_dedup.without_repeats(docs)
    changed = F.col(cut).isNotNull()
    blank = F.translate("text", WHITE_CHARS, "") == ""
    out = out.where(~(changed & blank) | ~changed)
    n_chars = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.one_of_each(docs, near_dedup.Similarity(percent=80))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by raked source, language and topic weights."""
    return mixing.sample(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_chunks),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("mixing", target_mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
