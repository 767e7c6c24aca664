"""Helpers the operators share: tidy input columns, written tables, gapless numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from astrolode.session import apply_defaults, shared_dir

# Rows per Arrow batch: small enough that a batch of long documents stays a few megabytes.
ARROW_ROWS = 1000


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's defaults and small Arrow batches."""
    apply_defaults(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(ARROW_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *columns: str) -> DataFrame:
    """`doc_id`, the text (null counts as empty) and the named columns; all others are left out,
    so that extra columns of any name cannot clash with those an operator adds."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *columns)


def key_type(df: DataFrame, name: str = "doc_id") -> str:
    return df.schema[name].dataType.simpleString()


def gathered(batches: Iterable[pa.RecordBatch], chars: int, column: str = "text"
             ) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together until their texts reach about so many bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch[column].nbytes
        if size >= chars:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size or any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: it survives lost executors and is computed once."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row(df: DataFrame) -> DataFrame:
    """A different `_row` per row, to be written at once: only then it stays what it is."""
    return df.withColumn("_row", F.monotonically_increasing_id())


def numbered(df: DataFrame, group: str, name: str) -> DataFrame:
    """Gapless numbers from 0 within `group`, without holding a group in one task.

    `df` is a written table with `_row`. A group is cut into parts by a hash of `_row`; rows are
    numbered within a part, and a running sum of the parts' counts says where each part begins.
    Equal rows differ in `_row`, so that no part is larger than others by chance of the data.
    """
    parts = partitions(df.sparkSession)
    parted = df.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)).cast("int"))
    within = Window.partitionBy(group, "_part").orderBy("_row")
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parted.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select(group, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    ranked = parted.withColumn("_rank", F.row_number().over(within) - 1)
    return (
        ranked.join(starts, [group, "_part"])
        .withColumn(name, (F.col("_start") + F.col("_rank")).cast("long"))
        .drop("_part", "_rank", "_start", "_row")
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(value: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
