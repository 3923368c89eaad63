"""Incremental runs: each micro-batch of arriving files is upserted into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelsift.sources.writers import merge_updates


def watch_folder(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None):
    """Stream of the files that arrive in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def start_upsert(
    arriving: DataFrame,
    table: str,
    key: str,
    checkpoint: str,
    base_path: str,
    clean: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    order_by: list | None = None,
) -> StreamingQuery:
    """Clean every micro-batch and upsert it by key. A repeated batch leaves the table as it is, so retries are safe.

    On a table from ``publish_bucketed`` a batch rewrites only the buckets it has keys of. Rows without a key end the
    stream with an error, since a retry would add them again.
    """

    def apply(batch: DataFrame, _: int) -> None:
        merge_updates(table, clean(batch), key, base_path=base_path, order_by=order_by, null_keys="raise")
        # Batches run in a session of their own; the caller's has to learn of the new folder.
        arriving.sparkSession.catalog.refreshTable(table)

    return (
        arriving.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
