"""Corpus pipeline: toxic documents go, then poor ones, then near copies; the rest is packed.

Each stage takes the documents that the one before kept. The filters judge each row by its
own text, also rows without an id or that repeat one; a row without text counts as empty.
Rows without text or id are never near copies. Rows that a stage keeps are whole rows of
its input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from linkweave.llm import neardup, packing, quality, toxicity
from linkweave.llm.common import DOCUMENT_COLUMNS, pick, shared_folder, table


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(pick(docs, *DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def poor_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.without_poor(pick(docs, *DOCUMENT_COLUMNS), table(spark, sf_dir, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one_of_each(pick(docs, *DOCUMENT_COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("quality", poor_out),
    ("near_duplicates", near_copies_out),
    ("packing", packed),
]

#: Trained models, alignments and a genetic algorithm: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again by the next."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
