"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. All but
the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curbflow.llm import decontamination, language_id, near_dedup, packing, quality_rules
from curbflow.llm.common import sent_if_small, table, written
from curbflow.session import ensure_checkpoint_dir


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules predict 1 for, learned from the labels that aren't held out."""
    model = quality_rules.train(docs, table(spark, folder, "labels"), lambda key: ~quality_rules.held_out(key))
    return quality_rules.good_rows(docs, model)


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is told; those without letters or without a clear language go."""
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))).select("lang", "text"))
    return language_id.known_rows(docs, model)


def same_text() -> Column:
    """Whether a row has the doc_id and the text of a row (_id, _version)."""
    return F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_version"))


def one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One text of each group of near-duplicates, that with the smallest doc_id; of rows with one doc_id and text one.

    Other texts under the doc_id of a near-duplicate stay. Rows without doc_id and texts without words stay as they are."""
    gone = near_dedup.other_texts(docs)
    left = docs.join(sent_if_small(written(gone.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")))), same_text(), "left_anti")
    repeated = left.where("doc_id is not null").groupBy("doc_id", F.xxhash64("text").alias("_version")).count().where("count > 1")
    repeated = written(repeated.select(F.col("doc_id").alias("_id"), "_version"))
    if repeated.isEmpty():
        return left
    # Of equal rows the first stays; a group of them goes to its task as one row a map task.
    several = left.join(sent_if_small(repeated), same_text(), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(sent_if_small(repeated), same_text(), "left_anti").unionByName(several)


def without_benchmarks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that aren't contaminated by benchmark items."""
    found = decontamination.judged(docs, table(spark, folder, "benchmark")).where("contaminated")
    gone = sent_if_small(written(found.select(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).distinct()))
    return docs.join(gone, same_text(), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences."""
    return packing.packed_documents(docs, packing.word_vocabulary())


STAGES = [
    ("quality classifier", good_quality),
    ("language id", known_language),
    ("near dedup", one_of_each),
    ("decontamination", without_benchmarks),
    ("packing", packed),
]
# Trained models have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to documents; what a stage returns is written to the shared folder and read again."""
    ensure_checkpoint_dir(spark)
    kept = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, folder).write.parquet(f"{kept}/{number}")
        docs = spark.read.parquet(f"{kept}/{number}")
    return docs
