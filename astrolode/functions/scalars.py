"""Scalar helpers: casts that yield NULL on bad input, calendar attributes, amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from astrolode.functions.predicates import literal, not_blank_sql, quoted
from astrolode.spec import UNKNOWN


def safe_cast(df: DataFrame, name: str, target: str, date_format: str) -> Column:
    """Cast a column; what cannot be read becomes NULL, also under ANSI mode.

    Columns that already hold a time are passed through, so cleaning twice changes nothing.
    """
    value = quoted(name)
    if target != "timestamp":
        return F.expr(f"try_cast({value} AS {target})")
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(value)
    return F.expr(f"try_to_timestamp(CAST({value} AS STRING), {literal(date_format)})")


def trimmed(name: str) -> Column:
    return F.expr(f"trim(CAST({quoted(name)} AS STRING))")


def or_unknown(df: DataFrame, name: str, default: str = UNKNOWN) -> Column:
    """Blank becomes the default, anything else stays untouched (not trimmed)."""
    value = quoted(name)
    return F.expr(f"CASE WHEN {not_blank_sql(df, name)} THEN {value} ELSE {literal(default)} END")


def date_key(moment: Column) -> Column:
    """20240131 for 31 January 2024, by arithmetic rather than through text."""
    day = F.to_date(moment)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The derived columns of a calendar dimension; day_of_week counts from Sunday = 1."""
    return {
        "date_key": date_key(day),
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_of_week": F.dayofweek(day),
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def line_amount(price: Column, quantity: Column, discount: Column) -> Column:
    return price * quantity * (F.lit(1) - discount)
