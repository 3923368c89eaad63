"""Streams that stop and start again: windows with late rows, one row per key, repeats."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from reelsift.operators.dedup import latest_per_key
from reelsift.sources import writers
from reelsift.streaming import counts, incremental, keyed

SCHEMA = "id int, key string, ts timestamp_ntz"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


class Inbox:
    def __init__(self, spark, folder, schema=SCHEMA):
        self.spark, self.folder, self.schema = spark, str(folder / "inbox"), schema
        self.put()
        self.stream = incremental.watch_folder(spark, self.folder, schema, files_per_batch=1)

    def put(self, *data):
        told = [(i, key, datetime.fromisoformat(ts) if ts else None) for i, key, ts in data]
        self.spark.createDataFrame(told, self.schema).coalesce(1).write.mode("append").parquet(self.folder)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_late_rows_are_counted_within_the_watermark(spark, tmp_path, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        inbox, folder, checkpoint = Inbox(spark, tmp_path), str(tmp_path / "out"), str(tmp_path / "ckpt")

        def run():
            windows = counts.windowed_counts(inbox.stream, "ts", "key", "1 day", late="2 days")
            counts.start_counts(windows, folder, checkpoint).awaitTermination()
            return {(r.window_start.day, r.key): r["count"] for r in counts.read_counts(spark, folder, "key").collect()}

        inbox.put((1, "a", "2024-01-10 00:00:00"), (2, "a", "2024-01-10 23:59:59"), (3, None, "2024-01-11 05:00:00"), (4, "a", None))
        assert run() == {(10, "a"): 2, (11, None): 1}
        inbox.put((5, "a", "2024-01-13 01:00:00"))
        assert run() == {(10, "a"): 2, (11, None): 1, (13, "a"): 1}
        # A day and a half late: in its own window. A week late: left out.
        inbox.put((6, "a", "2024-01-11 12:00:00"), (7, "a", "2024-01-05 12:00:00"))
        want = {(10, "a"): 2, (11, None): 1, (13, "a"): 1, (11, "a"): 1}
        assert run() == want and run() == want
        counts.compact_counts(spark, folder, str(tmp_path / "compact"), "key")
        compact = counts.read_counts(spark, str(tmp_path / "compact"), "key")
        assert {(r.window_start.day, r.key): r["count"] for r in compact.collect()} == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_failed_batch_is_written_over(spark, tmp_path):
    inbox, folder = Inbox(spark, tmp_path), tmp_path / "out"
    inbox.put((1, "a", "2024-01-10 00:00:00"))
    spark.createDataFrame([("half",)], "x string").write.parquet(f"{folder}/batch=0")
    windows = counts.windowed_counts(inbox.stream, "ts", "key", "1 day")
    counts.start_counts(windows, str(folder), str(tmp_path / "ckpt")).awaitTermination()
    assert [r["count"] for r in counts.read_counts(spark, str(folder), "key").collect()] == [1]


@pytest.mark.parametrize("newest", [True, False])
def test_one_row_per_key(spark, database, tmp_path, newest):
    inbox, table = Inbox(spark, tmp_path), f"{database}.best"
    order = keyed.newest_first("ts", "id") if newest else keyed.oldest_first("ts", "id")
    batches = [
        [(1, "a", "2024-01-10 00:00:00"), (2, "b", "2024-01-10 00:00:00"), (3, None, "2024-01-09 00:00:00")],
        [(4, "a", "2024-01-08 00:00:00"), (1, "a", "2024-01-10 00:00:00"), (5, "c", "2024-01-01 00:00:00")],
        [(6, "a", "2024-01-12 00:00:00"), (7, "b", "2023-01-12 00:00:00"), (8, None, "2024-01-19 00:00:00"), (5, "c", "2024-01-01 00:00:00")],
    ]
    for batch in batches:
        inbox.put(*batch)
        keyed.start_best(inbox.stream, table, "key", order, str(tmp_path / "ckpt"), str(tmp_path / "base"), buckets=3).awaitTermination()
    everything = spark.read.schema(SCHEMA).parquet(inbox.folder)
    want = latest_per_key(everything, "key", "ts", ["id"]) if newest else everything.groupBy("key").agg(F.min_by("id", F.struct("ts", "id")).alias("id"))
    assert rows(keyed.read_best(spark, table), "id", "key") == rows(want, "id", "key")
    # A batch that is run again changes nothing.
    before = rows(spark.table(table))
    writers.merge_best(everything, table, "key", order, str(tmp_path / "base"))
    assert rows(spark.table(table)) == before


def test_repeats_are_dropped(spark, tmp_path):
    inbox, folder, checkpoint = Inbox(spark, tmp_path), str(tmp_path / "out"), str(tmp_path / "ckpt")
    batches = [
        [(1, "a", "2024-01-10 00:00:00"), (1, "a", "2024-01-10 00:00:00"), (2, "b", "2024-01-10 00:00:00")],
        [(2, "b", "2024-01-10 00:00:00"), (3, "c", "2024-01-11 00:00:00")],
        [(3, "c", "2024-01-11 00:00:00"), (4, None, "2024-01-20 00:00:00")],
    ]
    for batch in batches:
        inbox.put(*batch)
        keyed.start_append(keyed.distinct_within(inbox.stream, ["id"], "ts", "2 days"), folder, checkpoint).awaitTermination()
    out = spark.read.schema(inbox.stream.schema).parquet(folder)
    assert rows(out, "id", "key") == [(1, "a"), (2, "b"), (3, "c"), (4, None)] and out.columns == ["id", "key", "ts"]
