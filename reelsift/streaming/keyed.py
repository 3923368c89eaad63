"""One row per key on a stream: repeats dropped while they are likely, or the first or latest row kept in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelsift.functions.text import as_list
from reelsift.sources import writers
from reelsift.streaming.counts import EVENT_TIME, with_event_time


def distinct_within(arriving: DataFrame, keys: str | list[str], time: str, delay: str) -> DataFrame:
    """The first arrival of each key; repeats are dropped that come within ``delay`` of event time.

    A key leaves the state store when the newest row is ``delay`` past it, so the state holds that much of the
    stream and not all of it. Rows that come later than that are dropped as late.
    """
    return with_event_time(arriving, time, delay).dropDuplicatesWithinWatermark(as_list(keys)).drop(EVENT_TIME)


def start_append(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's rows to a folder of parquet files, each row once whatever fails."""
    return rows.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_best(arriving: DataFrame, table: str, key: str, order_by: list, checkpoint: str, base_path: str, buckets: int = 16) -> StreamingQuery:
    """Keep the first row of each key in ``order_by`` in a table: the latest by ``[F.col(time).desc(), ...]``, the earliest by ``[time, ...]``.

    The table is the state. A batch is cut to one row per key, and the buckets of its keys are written anew with the better of
    the two rows; a row that comes late or again changes nothing that it should not, however late it is. So a
    batch that is repeated leaves the table as it is. ``order_by`` should tell any two rows of a key apart.
    """

    def apply(batch: DataFrame, _: int) -> None:
        writers.merge_best(batch, table, key, order_by, base_path, buckets)
        # Batches run in a session of their own; the caller's has to learn of the new folder.
        arriving.sparkSession.catalog.refreshTable(table)

    return arriving.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_best(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(writers.KEY_BUCKET)


def newest_first(time: str, *tie_breakers: str) -> list:
    return [F.col(time).desc(), *tie_breakers]


def oldest_first(time: str, *tie_breakers: str) -> list:
    return [F.col(time).asc(), *tie_breakers]
