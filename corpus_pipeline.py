"""The corpus pipeline: quality, language, repeated lines, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import language_id, line_dedup, near_dup, packing, quality
from docgraph.sources import scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document goes whose best language is less likely than this.
MIN_LANGUAGE_SCORE = 0.5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    judged = quality.quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.join(judged.filter(~F.col("accepted")).select("doc_id"), "doc_id", "left_anti").select(COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    told = language_id.language_id(docs)
    rejected = told.filter((F.col("lang_pred") == "und") | (F.col("score") < MIN_LANGUAGE_SCORE))
    return docs.join(rejected.select("doc_id"), "doc_id", "left_anti").select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat elsewhere; n_chars follows the text."""
    drop = line_dedup.dropped_lines(docs)
    text = line_dedup.without(F.col("text"), F.col("drop"))
    kept = docs.join(drop, "doc_id", "left").withColumn("text", F.when(F.col("drop").isNull(), F.col("text")).otherwise(text))
    return kept.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast("long")).select(COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    gone = near_dup.near_duplicates(docs).filter(~F.col("kept")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of training sequences that hold the documents."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

#: Stages learn models and search neighbours, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    folder = scratch.new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.materialise(stage(spark, docs, sf_dir), folder, f"stage_{i}")
    return docs
