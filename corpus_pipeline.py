"""The corpus pipeline: documents in, packed training sequences out.

Five stages, each on all that the stage before it kept: toxic documents go, one of
each group of equal texts stays, one of each group of near copies stays, the sources
are mixed to their target weights (a document comes as often as the mix takes it),
and everything is packed into sequences. Every stage's result is a Parquet table in
the shared folder, so the loss of an executor never reaches back over a stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from marquee.llm.common import read, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject (score below 0.7)."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"),
                           usable=toxicity.trainable(F.col("id")))
    return toxicity.accepted(docs, model, threshold=0.7).select(*COLUMNS)


def unique_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.kept_documents(docs, keep="max").select(*COLUMNS)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at 0.75, that with the smallest id."""
    return jaccard_join.representatives(docs, threshold=75).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents repeated or left out."""
    return mixing.mixed_documents(docs, weights=(3.0, 1.0, 2.0), budget=1.5,
                                  cap=2.0).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, with their token ids, sequence and place."""
    return packing.pack(docs, with_ids=True)


STAGES = [("toxicity", not_toxic), ("exact_dedup", unique_texts),
          ("near_dedup", no_near_copies), ("mixing", mixed), ("packing", packed)]
# Learned scores, seeded rounding and tokenizing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
