"""Data quality: every check of a table in one pass, plus one for its keys.

Checks are rows `(table_name, check_name, column_name, value, flagged)`, so reports over
many tables are unions of small aggregates and run as one Spark job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from astrolode.functions.predicates import (
    all_blank_sql,
    all_not_blank,
    literal,
    not_blank_sql,
    quoted,
)
from astrolode.spec import AUDIT, CATALOG, CORRUPT_RECORD, UNDECLARED, TableSpec

ROWS = "rows"
BLANK = "blank_values"
MISSING = "missing_required"
REQUIRED_BLANK = "required_blank"
FULLY_BLANK = "fully_blank_rows"
UNREADABLE = "unreadable_rows"
UNDECLARED_FIELDS = "rows_with_undeclared_fields"
DUPLICATE_GROUPS = "duplicate_groups"
DUPLICATE_ROWS = "duplicate_rows"


_NOTED = {CORRUPT_RECORD: UNREADABLE, UNDECLARED: UNDECLARED_FIELDS}


class QualityError(RuntimeError):
    """Raised by `enforce` when a gate fails."""


def _check(name: str, column_name: str | None, value: str, flagged: str | None = None) -> str:
    """One check as SQL text of four values."""
    named = "CAST(NULL AS STRING)" if column_name is None else literal(column_name)
    return f"'{name}', {named}, CAST({value} AS BIGINT), {flagged or f'{value} > 0'}"


def _as_rows(counts: DataFrame, table: str, checks: Iterable[str]) -> DataFrame:
    """Turn the one row of counts into a row per check."""
    checks = list(checks)
    rows = f"stack({len(checks)}, {', '.join(checks)})"
    return counts.selectExpr(
        f"{literal(table)} AS table_name", f"{rows} AS (check_name, column_name, value, flagged)"
    )


def _count(condition: str) -> str:
    # Not `count_if`: it names its condition in a projection below, and where one named
    # condition contains others, a filter above makes Spark try every mix of the names.
    return f"count(CASE WHEN {condition} THEN 1 END)"


def column_checks(df: DataFrame, table: str, required: Sequence[str] = (),
                  ignore: Iterable[str] = AUDIT) -> DataFrame:
    """Row count, blanks per column, required columns, fully blank rows: one aggregate.

    A `blank_values` check is flagged when the column is blank in every row. Where ingest has
    noted lines that did not parse, or fields nobody declared, their rows are counted and
    flagged; a line that did not parse at all is also a fully blank row. The aggregate is a
    single row per map task, so no data but counts is shuffled.
    """
    noted = {c: check for c, check in _NOTED.items() if c in df.columns}
    names = [n for n in df.columns if n not in noted]
    ignored = set(ignore)
    business = [n for n in names if n not in ignored]
    counts = df.selectExpr(
        "count(1) AS rows",
        f"{_count(all_blank_sql(df, business))} AS fully_blank",
        *(f"count({quoted(c)}) AS {check}" for c, check in noted.items()),
        *(f"{_count('NOT ' + not_blank_sql(df, n))} AS blank_{i}" for i, n in enumerate(names)),
    )
    blanks = {n: f"blank_{i}" for i, n in enumerate(names)}
    checks = [_check(ROWS, None, "rows", "false"), _check(FULLY_BLANK, None, "fully_blank")]
    checks += [_check(check, None, check) for check in noted.values()]
    checks += [_check(BLANK, n, blank, f"{blank} = rows") for n, blank in blanks.items()]
    checks += [_check(REQUIRED_BLANK, n, blanks[n]) for n in required if n in blanks]
    checks += [_check(MISSING, n, "0" if n in blanks else "1") for n in required]
    return _as_rows(counts, table, checks)


def duplicate_keys(df: DataFrame, keys: Sequence[str], ignore_blank: bool = True) -> DataFrame:
    """One row: number of repeated keys, and of rows beyond the first of each key.

    With `ignore_blank` a row with any blank key part is left out; without, NULL is a key
    like any other. Counting starts before the shuffle, so a hot key costs one row per task.
    """
    rows = df.select(*map(quoted, keys))
    if ignore_blank:
        rows = rows.filter(all_not_blank(rows, keys))
    sizes = rows.groupBy(*map(quoted, keys)).agg(F.expr("count(1) AS _n"))
    return sizes.filter("_n > 1").selectExpr(
        f"count(1) AS {DUPLICATE_GROUPS}",
        f"coalesce(sum(_n - 1), 0) AS {DUPLICATE_ROWS}",
    )


def key_checks(df: DataFrame, table: str, keys: Sequence[str],
               ignore_blank: bool = True) -> DataFrame:
    """`duplicate_keys` as check rows."""
    counts = duplicate_keys(df, keys, ignore_blank)
    return _as_rows(counts, table, (_check(n, None, n) for n in (DUPLICATE_GROUPS, DUPLICATE_ROWS)))


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _checks(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], layer: str) -> DataFrame:
    bronze = layer == "bronze"
    parts = []
    for name, df in tables.items():
        spec = specs[name]
        required = spec.required_bronze if bronze else spec.required_silver
        parts.append(column_checks(df, name, required, spec.provenance))
        if set(spec.keys) <= set(df.columns):
            parts.append(key_checks(df, name, spec.keys, ignore_blank=bronze))
    return _union(parts)


def bronze_report(tables: Mapping[str, DataFrame],
                  specs: Mapping[str, TableSpec] = CATALOG) -> DataFrame:
    """All checks of all tables; `flagged` marks those that call for attention.

    The report changes nothing and stops nothing.
    """
    return _checks(tables, specs, "bronze")


def _total(check: str, name: str) -> Column:
    value = f"CASE WHEN check_name = '{check}' THEN value ELSE 0 END"
    return F.expr(f"sum({value}) AS {name}")


def silver_gate(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = CATALOG,
                missing_is_error: bool = True) -> DataFrame:
    """One row per table: error counts and CLEAN / NEEDS REVIEW.

    Required blanks are summed over columns, so one row can count more than once.
    `missing_is_error=False` leaves absent required columns out of the verdict.
    """
    totals = _checks(tables, specs, "silver").groupBy("table_name").agg(
        _total(ROWS, "rows"),
        _total(REQUIRED_BLANK, "required_nulls"),
        _total(MISSING, "missing_columns"),
        _total(DUPLICATE_GROUPS, "duplicate_keys"),
        _total(FULLY_BLANK, "fully_null_rows"),
    )
    empty = "CAST(CASE WHEN rows = 0 THEN 1 ELSE 0 END AS BIGINT)"
    errors = f"required_nulls + duplicate_keys + fully_null_rows + {empty}"
    if missing_is_error:
        errors += " + missing_columns"
    return totals.selectExpr(
        "*",
        f"{empty} AS empty_table",
        f"{errors} AS errors",
        f"CASE WHEN {errors} = 0 THEN 'CLEAN' ELSE 'NEEDS REVIEW' END AS status",
    )


def verdict(gate: DataFrame) -> DataFrame:
    """One row over all tables: total errors and PASSED / FAILED."""
    total = "coalesce(sum(errors), 0)"
    return gate.selectExpr(
        "count(1) AS tables",
        f"{total} AS total_errors",
        f"CASE WHEN {total} = 0 THEN 'PASSED' ELSE 'FAILED' END AS verdict",
    )


def enforce(gate: DataFrame) -> None:
    """Raise `QualityError` naming the tables that need review (one row per table)."""
    bad = gate.filter(F.col("errors") > 0).select("table_name", "errors").collect()
    if bad:
        listing = ", ".join(f"{r.table_name} ({r.errors})" for r in sorted(bad))
        raise QualityError(f"quality gate failed: {listing}")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, one job for all."""
    return _union(
        df.selectExpr("count(1) AS rows").select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    )


def presence(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Per expected table whether it is there, and its rows (0 if not)."""
    missing = [(name, False, 0) for name, df in tables.items() if df is None]
    parts = [spark.createDataFrame(missing, "table_name STRING, found BOOLEAN, rows BIGINT")]
    found = {name: df for name, df in tables.items() if df is not None}
    if found:
        parts.append(row_counts(found).selectExpr("table_name", "true AS found", "rows"))
    return _union(parts)
