"""Audit columns: where a row came from and when it was taken in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from astrolode.spec import BATCH_TIME, BATCH_TIME_FORMAT, INGESTED_AT, SOURCE_FILE

# One spelling of a file's URI everywhere: the ledger compares these strings.
FILE_PATH = "_metadata.file_path"


def stamp_ingest_time(df: DataFrame) -> DataFrame:
    return df.withColumn(INGESTED_AT, F.current_timestamp())


def stamp_source(df: DataFrame) -> DataFrame:
    """Add source file and ingestion time; `df` must be a file scan (batch or stream)."""
    return stamp_ingest_time(df.select("*", F.col(FILE_PATH).alias(SOURCE_FILE)))


def stamp_batch_time(df: DataFrame) -> DataFrame:
    """Add the producer's batch time, as text."""
    return df.withColumn(BATCH_TIME, F.date_format(F.current_timestamp(), BATCH_TIME_FORMAT))


def source_system(name: str) -> Column:
    return F.lit(name).alias("source_system")


def built_at() -> Column:
    return F.current_timestamp().alias("gold_created_at")
