"""astrolode: landing files to a published star schema, as plain Spark jobs.

Layers: landing (JSON lines) -> bronze (raw + provenance) -> silver (typed, clean,
one row per business key) -> gold (dimensions and fact) -> any Spark sink.
"""

from astrolode.spec import CATALOG, GOLD_TABLES, PROVENANCE, TableSpec

__all__ = ["CATALOG", "GOLD_TABLES", "PROVENANCE", "TableSpec"]
