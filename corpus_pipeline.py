"""Corpus pipeline: toxicity -> exact dedup -> SimHash near-dedup -> mixing -> BPE.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet into the shared checkpoint folder and reads it
again as the next stage's ``docs``.  All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, exact_dedup, mixing, queries, simhash, toxicity
from ledgerline.session import TableScope, materialize


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5; the labels of one fold are left out of the training."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels, train_rows=queries.training_rows()))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies, the document with the smallest doc_id."""
    return simhash.drop_near_copies(docs, shingle_words=3, radius=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each pass that takes words of a document."""
    mixed = mixing.Mix(docs).documents()
    return mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else mixed


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row and the digests of ids and decoded text."""
    return bpe.round_trip(docs, queries.tokenizer_path(), with_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Learned scores, fingerprints of a seeded hash and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with TableScope(spark) as scope:            # what a stage wrote on its way goes with the stage
            docs = scope.result(materialize(stage(spark, docs, sf_dir)))
    return STAGES[-1][1](spark, docs, sf_dir)
