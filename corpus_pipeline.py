"""The corpus pipeline: toxic documents go, then exact and near copies, and the rest is packed.

STAGES are (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a frame;
each result is written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from astrolode.llm import exact_dedup, packing, simhash, toxicity
from astrolode.llm.common import ready, table, written
from astrolode.llm.queries import WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score stays below the threshold. Learns from what this stage is given."""
    ready(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ready(spark)
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked."""
    ready(spark)
    return simhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, each with its sequence and offset."""
    ready(spark)
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("packing", pack),
]

# The classifier, XXH64 fingerprints and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
