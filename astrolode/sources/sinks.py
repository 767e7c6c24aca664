"""Writing layer tables and landing batches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Of layer tables; they take about a quarter less room than by Spark's default.
CODEC = "zstd"


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return the number of rows written, in one action.

    The count sits right below the write, in the job's last stage, where Spark counts
    each partition once even when tasks are retried or run twice.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def append_parquet(df: DataFrame, path: str) -> int:
    return write_counted(df, lambda d: d.write.mode("append").parquet(path, compression=CODEC))


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Replace a table.

    With `partition_by` the rows are first rebalanced on those columns: a partition value
    gets few files, and one that holds much of the data is split over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    return write_counted(
        df, lambda d: d.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=CODEC)
    )


def overwrite_bucketed(df: DataFrame, table: str, path: str, buckets: int,
                       keys: Sequence[str]) -> int:
    """Replace a catalog table bucketed on its join key.

    Two tables with the same buckets join without a shuffle. A bucket is one task and is
    not split for skew, so use it only for keys that no large share of the rows has.
    """
    def write(d: DataFrame) -> None:
        d.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).saveAsTable(table)

    return write_counted(df.repartition(buckets, *keys), write)


def write_json_lines(df: DataFrame, path: str) -> None:
    """A batch of JSON-lines files, NULL fields included.

    Every line repeats all names, so plain lines take many times the room of the rows. A gzip file
    cannot be split: it is read by one task, as it was written by one.
    """
    (
        df.write.mode("errorifexists")
        .option("ignoreNullFields", False)
        .option("compression", "gzip")
        .json(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, values and names kept as they are, spaces included."""
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@dataclass(frozen=True)
class Target:
    """Where published tables go: a Spark format and the options for one table."""

    format: str
    options_for: Callable[[str], Mapping[str, str]]

    def write(self, df: DataFrame, table: str) -> int:
        options = dict(self.options_for(table))
        return write_counted(
            df, lambda d: d.write.format(self.format).options(**options).mode("overwrite").save()
        )


def connector(fmt: str, options: Mapping[str, str]) -> Target:
    """A warehouse reached through a connector that takes the table as `dbtable`."""
    return Target(fmt, lambda table: {**options, "dbtable": table})


def files(fmt: str, base: str) -> Target:
    """Files below a base URI, one folder per table."""
    return Target(fmt, lambda table: {"path": f"{base.rstrip('/')}/{table}"})


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of the session catalog, stored below a base URI."""

    database: str
    base: str

    def write(self, df: DataFrame, table: str) -> int:
        location = f"{self.base.rstrip('/')}/{table}"
        return write_counted(
            df,
            lambda d: d.write.mode("overwrite")
            .option("path", location)
            .saveAsTable(f"{self.database}.{table}"),
        )
