"""Landing files to bronze: each file is taken in once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from astrolode.functions.provenance import FILE_PATH, stamp_ingest_time
from astrolode.session import run_each, shared_dir
from astrolode.sources.files import landing_schema, or_none, read_landing
from astrolode.sources.sinks import overwrite_parquet
from astrolode.spec import APPEND, CATALOG, SOURCE_FILE, TableSpec

# Outcomes of one table's ingest.
NO_FILES = "no files"
NOTHING_NEW = "nothing new"
INGESTED = "ingested"

MAX_FILES_PER_APPEND = 10_000


@dataclass(frozen=True)
class IngestResult:
    table: str
    status: str
    new_rows: int


def unseen_rows(rows: DataFrame, bronze: DataFrame | None) -> DataFrame:
    """Rows whose `source_file` bronze does not hold yet (an anti-join on distinct files).

    The files are written first: by the size of bronze they look large, and all rows would be
    shuffled by file, a few files' rows into one task. Their true size lets Spark broadcast them.
    """
    if bronze is None or SOURCE_FILE not in bronze.columns:
        return rows
    held, path = bronze.select(SOURCE_FILE).distinct(), shared_dir(bronze.sparkSession, "held_files")
    held.write.parquet(path)
    return _not_among(rows, rows.sparkSession.read.schema(held.schema).parquet(path))


def _not_among(rows: DataFrame, files: DataFrame) -> DataFrame:
    return rows.join(files, SOURCE_FILE, "left_anti")


def _listing_session(spark: SparkSession) -> SparkSession:
    # Listing reads file names and one dictionary-encoded column, so the usual split size
    # would make far too many near-empty tasks.
    session = spark.newSession()
    tasks = 4 * spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.files.maxPartitionNum", str(tasks))
    return session


def ledger_path(bronze: str) -> str:
    """The ledger of a bronze table, in a folder readers of the table pass over."""
    return f"{bronze.rstrip('/')}/_ledger"


def committed(bronze: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """The rows of finished appends, without their numbers.

    Appends are entered in the ledger one after another, so all up to its last number are
    finished, and a later folder belongs to an append that still runs or was cut off. The number
    is a partition column: such a folder is pruned, not read. A table that is not written in
    appends (by the stream, for example) is returned as it is.
    """
    if APPEND not in bronze.columns:
        return bronze
    if ledger is None:
        return bronze.filter(F.lit(False)).drop(APPEND)
    return bronze.filter(F.col(APPEND) <= ledger.agg(F.max(APPEND)).scalar()).drop(APPEND)


def read_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """A bronze table as of its last finished append."""
    return committed(spark.read.parquet(bronze), or_none(lambda: spark.read.parquet(ledger_path(bronze))))


def new_files(spark: SparkSession, landing: str, bronze: str) -> DataFrame | None:
    """Landed files not yet taken in, and the next append's number; None if nothing has landed.

    Only names are read: those in the landing zone and those in the ledger, which holds one
    short row per file; bronze itself is not.
    """
    session = _listing_session(spark)
    landed = or_none(lambda: session.read.format("binaryFile").load(landing))
    if landed is None:
        return None
    names = landed.select(F.col(FILE_PATH).alias(SOURCE_FILE))
    ledger = or_none(lambda: session.read.parquet(ledger_path(bronze)))
    if ledger is None:
        return names.withColumn("number", F.lit(0))
    fresh = _not_among(names, ledger.select(SOURCE_FILE).distinct())
    return fresh.withColumn("number", ledger.agg(F.max(APPEND) + 1).scalar().cast("int"))


def _literal_path(uri: str) -> str:
    """A listed URI as a path Spark reads as is: unescaped, wildcards taken literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _append(spark: SparkSession, rows: DataFrame, bronze: str, number: int, names: list[str]) -> int:
    """Write one append and then enter its files in the ledger.

    An append owns the folder of its number and overwrites it. One that was cut off is not in the
    ledger, so the next run has the same number and puts its rows in place of what was left.
    """
    folder = f"{APPEND}={number}"
    count = overwrite_parquet(rows, f"{bronze.rstrip('/')}/{folder}")
    entered = spark.createDataFrame([(n, count) for n in names], f"{SOURCE_FILE} STRING, rows BIGINT")
    entered.coalesce(1).write.mode("overwrite").parquet(f"{ledger_path(bronze)}/{folder}")
    return count


def ingest_table(spark: SparkSession, spec: TableSpec, landing: str, bronze: str,
                 schema: T.StructType | None = None,
                 max_files: int = MAX_FILES_PER_APPEND) -> IngestResult:
    """Append the rows of new landing files to bronze, with their provenance.

    `landing` is the folder of the landing zone, `bronze` the path of this table. Files
    already taken in are never opened, and bronze itself is not read. Every field is kept,
    those nobody declared in `_undeclared`. The driver holds at most `max_files` names at once;
    more files make more appends, never fewer rows. Two runs of one table must not overlap.
    """
    pattern = f"{landing.rstrip('/')}/{spec.pattern}"
    schema = schema or landing_schema(spec.landing_ddl)
    total = 0
    while (fresh := new_files(spark, pattern, bronze)) is not None:
        found = fresh.orderBy(SOURCE_FILE).limit(max_files).collect()
        if found:
            names = [row[SOURCE_FILE] for row in found]
            rows = stamp_ingest_time(read_landing(spark, [_literal_path(n) for n in names], schema))
            total += _append(spark, rows, bronze, found[0]["number"], names)
        if len(found) < max_files:
            return IngestResult(spec.name, INGESTED if total else NOTHING_NEW, total)
    return IngestResult(spec.name, NO_FILES, 0)


def ingest_all(spark: SparkSession, landing: str, bronze_path: Callable[[str], str],
               specs: Iterable[TableSpec] = tuple(CATALOG.values()),
               parallel: int = 1) -> list[IngestResult]:
    """Ingest every table; `bronze_path(name)` gives each its target."""
    def work(spec: TableSpec) -> IngestResult:
        return ingest_table(spark, spec, landing, bronze_path(spec.name))

    return run_each(spark, work, specs, parallel)


def total_new_rows(results: Iterable[IngestResult]) -> int:
    return sum(r.new_rows for r in results)
