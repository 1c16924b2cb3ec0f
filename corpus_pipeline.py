"""The corpus pipeline: stages over `documents`, each written and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from firmloom.llm import decontaminate, packing, resample, secrets, simhash
from firmloom.llm.common import shared_dir
from firmloom.llm.queries import WORD_VOCABULARY, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws: junk and toxic ones go."""
    return resample.select_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints over four-word shingles link at 4 bits or fewer."""
    return simhash.keep_one(docs, words=4, distance=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of a benchmark item occurs."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"), 10)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences of at most 4096 ids."""
    return packing.pack_documents(docs, WORD_VOCABULARY, 4096, 2)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret scans", secret_scan),
    ("packing", pack),
]

#: Trained models and tokenizers take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}/{name.replace(' ', '_')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
