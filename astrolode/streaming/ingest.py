"""Landing files to bronze as a stream; the checkpoint is the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from astrolode.functions.provenance import stamp_ingest_time
from astrolode.sources.files import landing_schema, stream_landing
from astrolode.spec import TableSpec

ANY_AGE = "36500d"


def landing_stream(spark: SparkSession, spec: TableSpec, landing: str,
                   schema: T.StructType | None = None,
                   max_files_per_trigger: int | None = None,
                   max_file_age: str = ANY_AGE) -> DataFrame:
    """New landing files of one table, stamped; `max_files_per_trigger` bounds a batch.

    A file counts however old it is. A shorter `max_file_age` (from the newest file) lets
    the source forget old names, at the price of passing over files that land that late.
    """
    options = {"maxFileAge": max_file_age}
    if max_files_per_trigger:
        options["maxFilesPerTrigger"] = max_files_per_trigger
    path = f"{landing.rstrip('/')}/{spec.pattern}"
    declared = schema or landing_schema(spec.landing_ddl)
    return stamp_ingest_time(stream_landing(spark, path, declared, **options))


def ingest_stream(spark: SparkSession, spec: TableSpec, landing: str, bronze: str, checkpoint: str,
                  schema: T.StructType | None = None, max_files_per_trigger: int | None = None,
                  once: bool = True) -> StreamingQuery:
    """Append every landing file exactly once.

    The file sink commits whole batches through its own log, so a batch cut off half-way
    leaves nothing behind that a reader sees. `once` takes what is there and stops.
    """
    stream = landing_stream(spark, spec, landing, schema, max_files_per_trigger)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
