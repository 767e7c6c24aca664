"""The jobs that move data from one layer to the next.

Each job loops over the tables of a fixed catalog; the work on a table is one Spark
action, and its row counts come from the write itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from astrolode.functions.provenance import stamp_batch_time
from astrolode.operators import clean as clean_ops
from astrolode.operators import quality, star
from astrolode.operators.clean import clean
from astrolode.operators.ingest import IngestResult, ingest_all
from astrolode.plans.lake import BRONZE, GOLD, SILVER, Lake
from astrolode.session import run_each, shuffles_dropped
from astrolode.sources.files import or_none
from astrolode.sources.sinks import overwrite_parquet, write_json_lines
from astrolode.spec import CATALOG, GOLD_TABLES, TableSpec


@dataclass(frozen=True)
class CleanResult:
    table: str
    rows_before: int
    rows_after: int


def land_batch(df: DataFrame, lake: Lake, table: str, batch: str) -> str:
    """Land one batch of a table as JSON lines, stamped with the batch time."""
    path = f"{lake.landing}/{table}_batch_{batch}.json"
    write_json_lines(stamp_batch_time(df), path)
    return path


def landing_to_bronze(spark: SparkSession, lake: Lake,
                      specs: Mapping[str, TableSpec] = CATALOG,
                      parallel: int = 1) -> list[IngestResult]:
    return ingest_all(
        spark, lake.landing, lambda t: lake.path(BRONZE, t), specs.values(), parallel
    )


def bronze_report(spark: SparkSession, lake: Lake,
                  specs: Mapping[str, TableSpec] = CATALOG) -> DataFrame:
    return quality.bronze_report(lake.read_layer(spark, BRONZE, specs), specs)


def bronze_to_silver(spark: SparkSession, lake: Lake, specs: Mapping[str, TableSpec] = CATALOG,
                     parallel: int = 1) -> list[CleanResult]:
    """Clean and overwrite every silver table.

    The count before is a Parquet footer count: no data is read for it, and unlike a
    counter inside the job it stays right when a map stage is run again.
    """
    def work(spec: TableSpec) -> CleanResult:
        bronze = lake.read(spark, BRONZE, spec.name)
        before = bronze.count()
        after = overwrite_parquet(clean(bronze, spec), lake.path(SILVER, spec.name))
        return CleanResult(spec.name, before, after)

    with shuffles_dropped(spark):
        return run_each(spark, work, specs.values(), parallel)


def clean_counts(spark: SparkSession, lake: Lake,
                 specs: Mapping[str, TableSpec] = CATALOG) -> DataFrame:
    """Per table, what cleaning leaves out and why: one aggregate over bronze, as one job."""
    parts = (
        clean_ops.clean_counts(lake.read(spark, BRONZE, name), spec)
        .select(F.lit(name).alias("table_name"), "*")
        for name, spec in specs.items()
    )
    return reduce(DataFrame.unionByName, parts)


def silver_gate(spark: SparkSession, lake: Lake, specs: Mapping[str, TableSpec] = CATALOG,
                strict: bool = False) -> DataFrame:
    """Gate rows for all silver tables; `strict` raises if any needs review."""
    gate = quality.silver_gate(lake.read_layer(spark, SILVER, specs), specs)
    if strict:
        quality.enforce(gate)
    return gate


def gold_frames(silver: Mapping[str, DataFrame], source: str) -> dict[str, DataFrame]:
    """The seven gold tables over the eight silver ones, not yet computed."""
    return {
        "dim_dates": star.dim_dates(silver["orders"]),
        "dim_customers": star.dim_customers(silver["customers"]),
        "dim_employees": star.dim_employees(silver["employees"], source),
        "dim_products": star.dim_products(silver["products"], silver["categories"], source),
        "dim_suppliers": star.dim_suppliers(silver["suppliers"], source),
        "dim_shippers": star.dim_shippers(silver["shippers"]),
        "fact_orders": star.fact_orders(
            silver["order_details"], silver["orders"], silver["products"]
        ),
    }


def silver_to_gold(spark: SparkSession, lake: Lake, source: str, partition_fact_by_year: bool = False,
                   parallel: int = 1) -> dict[str, int]:
    """Build and overwrite gold; returns the rows written per table."""
    frames = gold_frames(lake.read_layer(spark, SILVER, CATALOG), source)

    def work(table: str) -> int:
        df, partition_by = frames[table], ()
        if table == "fact_orders" and partition_fact_by_year:
            df, partition_by = df.withColumn("year", F.year("OrderDate")), ("year",)
        return overwrite_parquet(df, lake.path(GOLD, table), partition_by)

    with shuffles_dropped(spark):
        return dict(zip(GOLD_TABLES, run_each(spark, work, GOLD_TABLES, parallel)))


def gold_presence(spark: SparkSession, lake: Lake) -> DataFrame:
    """Which of the expected gold tables are there, with their rows."""
    # Looked for in a session of its own: a failed read is logged as an error by the
    # listener behind the row counts of writes, and here it is an expected answer.
    probe = spark.newSession()
    there = {t for t in GOLD_TABLES if or_none(lambda t=t: lake.read(probe, GOLD, t)) is not None}
    return quality.presence(
        spark, {t: lake.read(spark, GOLD, t) if t in there else None for t in GOLD_TABLES}
    )


def gold_summary(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per gold table as a frame; over written tables these are footer counts."""
    return quality.row_counts(frames)


def publish_name(table: str) -> str:
    return table.upper()


def publish_gold(spark: SparkSession, lake: Lake, target, parallel: int = 1) -> dict[str, int]:
    """Overwrite every published table from gold; returns rows per published name."""
    def work(table: str) -> int:
        return target.write(lake.read(spark, GOLD, table), publish_name(table))

    names = [publish_name(t) for t in GOLD_TABLES]
    return dict(zip(names, run_each(spark, work, GOLD_TABLES, parallel)))
