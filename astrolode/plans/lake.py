"""Where the layers live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from astrolode.operators.ingest import read_bronze

BRONZE, SILVER, GOLD = "bronze", "silver", "gold"


@dataclass(frozen=True)
class Lake:
    """Layer tables below one base URI; `prefix` goes before bronze and silver names."""

    base: str
    prefix: str = ""

    @property
    def landing(self) -> str:
        return f"{self.base.rstrip('/')}/landing"

    def path(self, layer: str, table: str) -> str:
        name = table if layer == GOLD else f"{self.prefix}{table}"
        return f"{self.base.rstrip('/')}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        """A layer table; of bronze only what finished appends brought."""
        path = self.path(layer, table)
        return read_bronze(spark, path) if layer == BRONZE else spark.read.parquet(path)

    def read_layer(self, spark: SparkSession, layer: str, tables) -> dict[str, DataFrame]:
        return {table: self.read(spark, layer, table) for table in tables}
