"""Bronze to silver as a stream, one row per business key over all batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from astrolode.functions.predicates import quoted
from astrolode.operators.clean import clean
from astrolode.operators.dedupe import keep_one, newest_first
from astrolode.sources.files import or_none
from astrolode.sources.sinks import overwrite_parquet
from astrolode.spec import TableSpec

BATCH_ID = "batch_id"
LATE = "is_late"
DAY = "event_day"


def _write_batch(spec: TableSpec, silver: str):
    """Write a batch's rows, one per key, into the folder of its id.

    Running a batch again after a failure overwrites its folder and gives the same table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{silver.rstrip('/')}/{BATCH_ID}={batch_id}"
        clean(batch, spec).write.mode("overwrite").parquet(folder)

    return write


def clean_stream(stream: DataFrame, spec: TableSpec, silver: str, checkpoint: str,
                 once: bool = True) -> StreamingQuery:
    """Clean each micro-batch; `read_silver` gives one row per key over all of them.

    A batch costs what its own rows cost: earlier ones are not read and no state grows. Of a
    key that several batches hold, the row that stays is chosen when reading, by the rule that
    batch cleaning uses. `compact` writes the outcome as a table. Columns that are empty in a
    batch are kept: a stream's schema does not change.
    """
    spec = spec.with_(drop_empty=False)
    writer = stream.writeStream.foreachBatch(_write_batch(spec, silver)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_silver(spark: SparkSession, silver: str, spec: TableSpec) -> DataFrame:
    """What `clean_stream` has written so far, one row per key."""
    rows = spark.read.parquet(silver).drop(BATCH_ID)
    return keep_one(rows, spec.keys, prefer=newest_first(rows, spec.prefer))


def compact(spark: SparkSession, silver: str, spec: TableSpec, target: str) -> int:
    """Write `read_silver` as a table of its own; returns its rows."""
    return overwrite_parquet(read_silver(spark, silver, spec), target)


def _marks(silver: str) -> str:
    return f"{silver.rstrip('/')}/_marks"


def _bound(spark: SparkSession, silver: str, batch_id: int, delay: str) -> Column | None:
    """The newest event time of earlier batches, less the delay."""
    marks = or_none(lambda: spark.read.parquet(_marks(silver))) if batch_id else None
    if marks is None:
        return None
    newest = marks.filter(F.col(BATCH_ID) < batch_id).agg(F.max("newest").alias("newest"))
    # Two values: as text, so that the driver's clock zone plays no part.
    newest = newest.select(F.date_format("newest", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    return None if newest is None else F.expr(f"TIMESTAMP '{newest}' - INTERVAL {delay}")


def _write_within(spec: TableSpec, event_time: str, delay: str, silver: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, F.col(quoted(event_time))
        bound = _bound(spark, silver, batch_id, delay)
        rows = clean(batch, spec)
        is_late = time.isNull() if bound is None else time.isNull() | (time < bound)
        marked = rows.withColumns({LATE: is_late.cast("int"), DAY: F.to_date(time)})
        if bound is not None:
            # Only days that on-time rows can fall on are read, and of these the keys.
            kept = spark.read.parquet(silver).filter(
                (F.col(BATCH_ID) < batch_id) & (F.col(LATE) == 0) & (F.col(DAY) >= F.to_date(bound)))
            kept = kept.select(*map(quoted, spec.keys), F.lit(0).alias(LATE)).distinct()
            marked = marked.join(kept, [*spec.keys, LATE], "left_anti").select(marked.columns)
        seen = Observation()
        marked = marked.observe(seen, F.max(event_time).alias("newest"))
        marked.write.mode("overwrite").partitionBy(LATE, DAY).parquet(
            f"{silver.rstrip('/')}/{BATCH_ID}={batch_id}")
        mark = spark.createDataFrame([(seen.get["newest"],)], "newest TIMESTAMP")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{_marks(silver)}/{BATCH_ID}={batch_id}")

    return write


def clean_stream_within(stream: DataFrame, spec: TableSpec, event_time: str, delay: str,
                        silver: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Clean and drop repeats of a key that arrive within `delay` (such as "2 days").

    What has to be looked at does not grow with the feed: a batch reads the keys of the days
    since the newest event time of earlier batches less `delay`. Rows older than that, or
    without an event time, cannot be judged; they are kept apart, and `read_late` gives them.
    """
    spec = spec.with_(drop_empty=False)
    writer = stream.writeStream.foreachBatch(_write_within(spec, event_time, delay, silver)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_within(spark: SparkSession, silver: str) -> DataFrame:
    """The rows `clean_stream_within` has kept as on time."""
    return spark.read.parquet(silver).filter(F.col(LATE) == 0).drop(BATCH_ID, LATE, DAY)


def read_late(spark: SparkSession, silver: str) -> DataFrame:
    """The rows that came too late to be judged."""
    return spark.read.parquet(silver).filter(F.col(LATE) == 1).drop(BATCH_ID, LATE, DAY)
