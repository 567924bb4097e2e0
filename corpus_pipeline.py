"""From raw documents to packed sequences: five stages, each over all rows of the one before.

Quality rules (documents that fail go), exact deduplication (the row with the largest id
stays), n-gram Jaccard join (the smallest id of each group stays), mixing of sources to
target weights, packing. Every stage but the last returns the columns of ``documents``.
Text of the mix that lies past a source's budget is cut off; documents taken more than once
come out as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import exact_dedup, jaccard, mixing, packing, risk_rules
from tidemark.llm import text as T
from tidemark.session import prepare


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    # Measured once: the labelled rows choose the limits, and all rows are held against them.
    rows = T.written(risk_rules.rows_with_measures(docs), spark, "quality-measures")
    narrow = rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_s").alias("stratum"), F.col("_m").alias("m"))
    limits = T.written(risk_rules.thresholds(narrow, labels), spark, "quality-limits")
    return risk_rules.keep_passed(rows, limits)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs, spark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, spark)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = T.written(mixing.sized(docs), spark, "mix-sizes")
    return mixing.mixed(docs, T.written(mixing.plan(rows), spark, "mix-plan"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, spark)


STAGES = [("quality", quality), ("exact_dedup", dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

#: The last stage needs a tokenizer and a least-squares solution, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all ``documents``; stages meet in tables in the shared folder."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = T.written(stage(spark, docs, sf_dir), spark, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
