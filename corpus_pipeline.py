"""From raw documents to packed training sequences, in stages that each write their result.

``STAGES`` lists the stages as (name, function). A function takes (spark, docs, sf_dir)
and returns the rows that go on; all but the last return the columns of the documents.
Null and empty texts leave at the first stage; a table without rows stays one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import bucket, read, unused
from shelfwise.llm.decontaminate import decontaminate
from shelfwise.llm.language import keep_identified, train_language
from shelfwise.llm.line_dedup import dedup_lines
from shelfwise.llm.packing import VECTOR, pack
from shelfwise.llm.simhash import drop_near_copies
from shelfwise.session import shared_dir

# SQL cannot express the language model nor the packing.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages, however close the next one; the model learns from those whose language is given."""
    model = train_language(docs.where(bucket("doc_id", 4) != 2).select("text", "lang"))
    return keep_identified(docs, model, together=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has; those of which no word is left go."""
    removed = unused(docs, "removed_lines")
    freed = dedup_lines(docs).where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        freed = freed.withColumn("n_chars", F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return freed.select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return drop_near_copies(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"), remove="documents")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in pieces, each with its sequence and its place there."""
    return pack(docs, capacities=VECTOR)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each on the written result of the one before."""
    rows = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
