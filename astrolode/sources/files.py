"""Reading landing files and layer tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from astrolode.functions.provenance import FILE_PATH
from astrolode.spec import BATCH_TIME, CORRUPT_RECORD, SOURCE_FILE, UNDECLARED

# Conditions that mean "nothing there yet"; any other analysis error is a real one.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None if its source does not exist (yet)."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def landing_schema(ddl: str, keep_corrupt: bool = True) -> T.StructType:
    """Declared landing schema, plus the producer's batch time and, unless declined, a
    column for the text of lines that do not fit."""
    schema = T.StructType.fromDDL(ddl)
    for name in (BATCH_TIME, CORRUPT_RECORD) if keep_corrupt else (BATCH_TIME,):
        if name not in schema.names:
            schema = schema.add(name, T.StringType())
    return schema


def read_json_lines(spark: SparkSession, path: str | list[str],
                    schema: T.StructType | str | None = None) -> DataFrame:
    """Permissive JSON-lines scan: bad lines give NULLs, never a failed job.

    Without a schema Spark reads the files once more to infer one; use that to discover
    a new feed, not to run it.
    """
    reader = spark.read.option("mode", "PERMISSIVE")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT_RECORD)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines of JSON text as declared columns, plus the fields nobody declared.

    `_undeclared` maps the names of such fields to their values as text; it is NULL where there
    are none. A line that does not fit is kept as text in `_corrupt_record`.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_RECORD}
    declared = F.array(*(F.lit(f.name) for f in schema.fields))
    more = F.map_filter(
        F.from_json("value", "map<string,string>", options), lambda k, _: ~F.array_contains(declared, k))
    # Only lines with such fields are parsed twice; for the others a look at their names is enough.
    unknown = F.size(F.array_except(F.json_object_keys("value"), declared)) > 0
    rows = lines.filter(F.trim("value") != "").select(
        F.from_json("value", schema, options).alias("_row"),
        F.when(unknown, more).alias(UNDECLARED), *(c for c in lines.columns if c != "value"),
    )
    rest = [c for c in rows.columns if c not in ("_row", UNDECLARED)]
    return rows.select("_row.*", UNDECLARED, *rest)


def read_landing(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Landed JSON lines with every field kept, and the file each row came from."""
    lines = spark.read.text(path).select("value", F.col(FILE_PATH).alias(SOURCE_FILE))
    return _parsed(lines, schema)


def stream_landing(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """`read_landing` as a stream; `options` go to the file source."""
    lines = spark.readStream.options(**options).text(path)
    return _parsed(lines.select("value", F.col(FILE_PATH).alias(SOURCE_FILE)), schema)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             infer: bool = False, multi_line: bool = True) -> DataFrame:
    """CSV with a header row whose names are trimmed; empty fields are NULL.

    Quoted fields may hold line breaks. Such a file cannot be split, so it is one task:
    land many moderate files, or pass `multi_line=False` for files known to have none.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    reader = reader.option("escape", '"').option("inferSchema", infer and schema is None)
    if schema is not None:
        # By position: the names in the files may be padded.
        return reader.schema(schema).option("enforceSchema", True).csv(path)
    df = reader.csv(path)
    return df.toDF(*(c.strip() for c in df.columns))


@dataclass(frozen=True)
class ReadResult:
    """Outcome of reading one table: a frame, or why there is none."""

    table: str
    df: DataFrame | None
    error: str | None = None


def read_all(readers: Mapping[str, Callable[[], DataFrame]]) -> dict[str, ReadResult]:
    """Read every table; one that cannot be planned is reported and the others go on.

    That covers absent sources and files whose header cannot be read. A file that turns out
    broken only while its rows are read fails the action that reads it.
    """
    results = {}
    for table, read in readers.items():
        try:
            results[table] = ReadResult(table, read())
        except (PySparkException, Py4JError) as error:
            condition = error.getCondition() if isinstance(error, PySparkException) else None
            results[table] = ReadResult(table, None, condition or str(error).splitlines()[0])
    return results

