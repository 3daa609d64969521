"""A corpus from raw documents to token ids, each stage by one operator of tidemark.llm.

Every stage works on all that its predecessor kept, is written as Parquet and read again as the next one's documents.

Defined results: a null text scores as the model's prior, is a near copy of other wordless texts only, loses nothing,
isn't contaminated and encodes as an empty text; a row without id is kept or dropped like any other, but is no one's
smallest id; of repeated rows one stays; further columns, whatever their names, pass through all stages but the last;
empty tables give empty results. All but the last stage return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, op4_simhash, op5_sentencepiece, op7_decontamination, op9_suffix_array, op10_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return op10_toxicity.stage(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return op4_simhash.stage(spark, docs, sf_dir)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut out of the texts."""
    return op9_suffix_array.stage(spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go."""
    return op7_decontamination.stage(spark, docs, sf_dir)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and the digests of ids and decoded text."""
    return op5_sentencepiece.stage(spark, docs, sf_dir)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Trained models, covering codes and merges by score are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is in the shared folder."""
    folder = f"{common.shared_folder(spark)}/tidemark-corpus-{uuid.uuid4().hex}"
    docs, before = common.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            common.removed(spark, before)  # what the next stage has been made of
        before = f"{folder}/{name}"
    return docs
