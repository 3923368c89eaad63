"""Counts per window of event time on a stream, right for rows that come late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelsift.functions.text import as_list

BATCH = "batch"
#: The column that watermarks go by.
EVENT_TIME = "event_time"


def with_event_time(arriving: DataFrame, time: str, late: str) -> DataFrame:
    """``arriving`` with its event time as an instant, watermarked.

    Watermarks need instants. A time without a zone is taken as if it were UTC, whatever the session's zone is, so windows
    begin where its own clock has them.
    """
    instant = F.col(time)
    if isinstance(arriving.schema[time].dataType, T.TimestampNTZType):
        instant = F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{time}`))")
    return arriving.withColumn(EVENT_TIME, instant).withWatermark(EVENT_TIME, late)


def without_zone(instant: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def windowed_counts(arriving: DataFrame, time: str, group_by: str | list[str], duration: str = "30 days", late: str = "1 day", count: str = "count") -> DataFrame:
    """``window_start``, the group columns and the rows of each window so far.

    Windows start at multiples of ``duration`` since 1970. A row that comes up to ``late`` after the newest one is counted in
    its own window; until then the window's count is in the state store, afterwards it is dropped from there, and rows
    that come for it still are left out. Rows without a time are left out. Counts are summed in the map tasks first.
    """
    window = F.window(EVENT_TIME, duration)
    counted = with_event_time(arriving, time, late).groupBy(window.alias("window"), *as_list(group_by)).agg(F.count("*").alias(count))
    start = F.col("window.start")
    if isinstance(arriving.schema[time].dataType, T.TimestampNTZType):
        start = without_zone(start)
    return counted.select(start.alias("window_start"), *as_list(group_by), count)


def start_counts(counts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write what each micro-batch changes to a folder of its own, over whatever a failed attempt left there."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}={number}")

    return counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_counts(spark: SparkSession, folder: str, group_by: str | list[str], count: str = "count") -> DataFrame:
    """The newest count of each window and group."""
    rows = spark.read.parquet(folder)
    return rows.groupBy("window_start", *as_list(group_by)).agg(F.max_by(count, BATCH).alias(count))


def compact_counts(spark: SparkSession, folder: str, into: str, group_by: str | list[str], count: str = "count") -> None:
    """One row per window and group in place of one per batch, in the new folder ``into``, readable as before.

    For a stream that stands still; it goes on writing to ``into`` afterwards, with the batch numbers that follow.
    """
    rows = spark.read.parquet(folder)
    last = rows.agg(F.max(BATCH)).first()[0]
    if last is not None:
        read_counts(spark, folder, group_by, count).write.parquet(f"{into}/{BATCH}={last}")
