"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from astrolode.functions.predicates import quoted


def _orderable(field: T.StructField) -> str:
    value = quoted(field.name)
    return f"to_json({value})" if isinstance(field.dataType, T.MapType) else value


def newest_first(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Sort expressions for the largest values first, of the columns that are there."""
    return [f"{quoted(c)} DESC NULLS LAST" for c in columns if c in df.columns]


def keep_one(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = (),
             keep: str = "first") -> DataFrame:
    """Keep one row per key.

    `keep="first"` takes the first row by `prefer` (SQL sort expressions, such as
    "updated_at DESC") and then by every other column, so a recomputed task or a second run
    keeps the same row; NULL comes last. Spark plans it as a group limit on both sides of the shuffle: each
    map task sends at most one row per key, however many rows a key has. `keep="any"`
    leaves the choice to Spark.
    """
    rest = [f for f in df.schema.fields if f.name not in keys]
    if keep == "any" or not rest:
        return df.dropDuplicates(list(keys))
    if keep != "first":
        raise ValueError(f"keep must be 'first' or 'any', not {keep!r}")
    by = ", ".join(map(quoted, keys))
    order = ", ".join([*prefer, *(f"{_orderable(f)} NULLS LAST" for f in rest)])
    rank = F.expr(f"row_number() OVER (PARTITION BY {by} ORDER BY {order})")
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
