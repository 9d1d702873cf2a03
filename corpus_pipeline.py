"""Corpus preparation: five stages, each an operator of ``gaugeline.llm`` over all its input.

A stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each as Parquet in the shared
folder and hands the stored table to the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import decontamination, minhash, packing, quality, secret_scan
from gaugeline.llm.common import store, table, workers_import_package

#: SQL has no counterpart for sampling with hashed models, sketches and packing.
ORACLE_SQL = None
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def columns(docs: DataFrame) -> list[Column]:
    """The columns of documents; other columns of the input go."""
    return [F.col(c) for c in DOCUMENTS]


def kept(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id ``decisions`` (doc_id, keep) keeps; null matches null.

    An id decided both ways, which only rows that share it can be, is kept. Decisions without text
    are what moves; rows of a hot id can be split by Spark.
    """
    ids = decisions.where("keep").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_kept_id")), "left_semi").select(
        *columns(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what importance resampling against the labelled good texts leaves out."""
    workers_import_package(spark)
    found = quality.importance_resample(docs, table(spark, sf_dir, "labels"))
    return kept(docs, found.select("doc_id", F.col("kept").alias("keep")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the least doc_id. Rows equal in doc_id and text
    become one; rows that share only the doc_id stay."""
    workers_import_package(spark)
    found = minhash.near_duplicates(docs, words=5, percent=80)
    return kept(docs, found.select("doc_id", F.col("kept").alias("keep"))).dropDuplicates(
        ["doc_id", "text"])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an exact passage of a benchmark item go."""
    workers_import_package(spark)
    found = decontamination.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return kept(docs, found.select("doc_id", (F.size("hits") == 0).alias("keep")))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; ``n_chars`` follows the text. Null texts stay null."""
    workers_import_package(spark)
    plain = docs.select(*columns(docs))
    model = secret_scan.train(secret_scan.pattern_labelled(plain))
    found = secret_scan.with_secret_spans(plain, model)
    changed = F.size("all_found") > 0
    text = F.when(changed, secret_scan.redacted(F.col("text"), F.col("all_found"))).otherwise(
        F.col("text"))
    return (found.withColumn("text", text)
            .withColumn("n_chars", F.when(changed, F.length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*columns(docs)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of at most 2048 tokens."""
    workers_import_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicates_stage),
          ("decontamination", decontamination_stage), ("secrets", secrets_stage),
          ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
