"""Blank / not-blank predicates.

Blank means NULL, or only spaces once read as text (tabs and newlines are content).
Only text can be blank without being NULL, so other types are tested for NULL alone:
no number or time is turned into text just to look at it.

The `*_sql` functions give the predicate as SQL text, to be put into a larger expression;
the others give a Column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = (T.StringType, T.CharType, T.VarcharType, T.BinaryType)


def quoted(name: str) -> str:
    """A column name as SQL text, also when it holds spaces or dots."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string as SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_blank_sql(df: DataFrame, name: str) -> str:
    value = quoted(name)
    if isinstance(df.schema[name].dataType, _TEXT):
        # Left-trimming is enough to tell, and unlike `trim` no cleaned column repeats it.
        return f"({value} IS NOT NULL AND ltrim(CAST({value} AS STRING)) <> '')"
    return f"({value} IS NOT NULL)"


def any_not_blank_sql(df: DataFrame, names: Iterable[str]) -> str:
    return "(" + (" OR ".join(not_blank_sql(df, n) for n in names) or "false") + ")"


def all_not_blank_sql(df: DataFrame, names: Iterable[str]) -> str:
    return "(" + (" AND ".join(not_blank_sql(df, n) for n in names) or "true") + ")"


def not_blank(df: DataFrame, name: str) -> Column:
    """True or False, never NULL."""
    return F.expr(not_blank_sql(df, name))


def is_blank(df: DataFrame, name: str) -> Column:
    return F.expr(f"NOT {not_blank_sql(df, name)}")


def any_not_blank(df: DataFrame, names: Iterable[str]) -> Column:
    """True if at least one column holds content; False for no columns at all."""
    return F.expr(any_not_blank_sql(df, names))


def all_not_blank(df: DataFrame, names: Iterable[str]) -> Column:
    return F.expr(all_not_blank_sql(df, names))


def all_blank_sql(df: DataFrame, names: Iterable[str]) -> str:
    names = list(names)
    return f"(NOT {any_not_blank_sql(df, names)})" if names else "false"


def all_blank(df: DataFrame, names: Iterable[str]) -> Column:
    """True for a row without any content; False when there is no column to judge."""
    return F.expr(all_blank_sql(df, names))


def all_present(names: Iterable[str]) -> Column:
    """NULL test only: a blank text passes."""
    return F.expr(" AND ".join(f"{quoted(n)} IS NOT NULL" for n in names) or "true")
