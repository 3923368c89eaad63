"""Streams of arriving event files, stopped and started again, against the batch result over all files."""

from pyspark.sql import functions as F

import workload.totals  # noqa: F401
from reelsift.streaming import counts, incremental, keyed
from workload.registry import REGISTRY, query

LATE = "event_id % 5 = 0"


def arriving(t, inbox: str, *slices):
    """A stream of one file per micro-batch, and functions that let each slice of events arrive."""
    events = t.events.select("event_id", "ts", "user_id", "event_type")
    events.limit(0).write.parquet(inbox)  # a stream watches a folder that is there
    stream = incremental.watch_folder(t.spark, inbox, events.schema, files_per_batch=1)
    return stream, [lambda s=s: events.where(s).coalesce(1).write.mode("append").parquet(inbox) for s in slices]


def counted(t, duration: str):
    """Two runs with a restart between them; the second one brings rows that are up to three days late."""
    inbox, folder, checkpoint = t.scratch(), t.scratch(), t.scratch()
    recent = "ts >= timestamp_ntz'2024-01-12 00:00:00' AND ts < timestamp_ntz'2024-01-15 00:00:00'"
    early = f"ts < timestamp_ntz'2024-01-15 00:00:00' AND NOT ({recent} AND {LATE})"
    stream, slices = arriving(t, inbox, early, f"NOT ({early})")
    for arrive in slices:
        arrive()
        windows = counts.windowed_counts(stream, "ts", "event_type", duration, late="4 days")
        counts.start_counts(windows, folder, checkpoint).awaitTermination()
    return counts.read_counts(t.spark, folder, "event_type")


@query("a7_stream_per_day", REGISTRY["a7_per_day"].sql)
def _(t):
    return counted(t, "1 day").select("event_type", F.col("window_start").alias("day"), F.col("count").alias("count_per_day"))


@query(
    "a7_stream_windows",
    "SELECT event_type, time_bucket(INTERVAL 10 DAY, ts, TIMESTAMP '1970-01-01') AS window_start, count(*) AS count FROM events GROUP BY ALL",
)
def _(t):
    return counted(t, "10 days")


# Three files in no order of time, each with rows that an earlier one had.
MIXED = ["event_id % 3 = 0", "event_id % 3 = 1 OR event_id % 4 = 0", "event_id % 3 = 2 OR event_id % 7 = 0"]


def best_rows(t, order_by):
    inbox, base, checkpoint, table = t.scratch(), t.scratch(), t.scratch(), f"{t.database()}.per_user"
    stream, slices = arriving(t, inbox, *MIXED)
    slices[0]()
    slices[1]()
    keyed.start_best(stream, table, "user_id", order_by, checkpoint, base, buckets=4).awaitTermination()
    slices[2]()
    keyed.start_best(stream, table, "user_id", order_by, checkpoint, base).awaitTermination()
    return keyed.read_best(t.spark, table).select("event_id", "user_id", "event_type", "ts")


@query("n2_stream_latest", REGISTRY["n2_latest"].sql)
def _(t):
    return best_rows(t, keyed.newest_first("ts", "event_id"))


@query("n3_stream_earliest", REGISTRY["n3_earliest"].sql)
def _(t):
    return best_rows(t, keyed.oldest_first("ts", "event_id"))


@query("a14_stream_distinct", "SELECT event_id, ts, user_id, event_type FROM events")
def _(t):
    # Each file repeats the last two days of the one before.
    day = lambda d: f"timestamp_ntz'2024-01-{d:02d} 00:00:00'"
    slices = [f"ts < {day(11)}", f"ts >= {day(9)} AND ts < {day(21)}", f"ts >= {day(19)}"]
    inbox, folder, checkpoint = t.scratch(), t.scratch(), t.scratch()
    stream, slices = arriving(t, inbox, *slices)
    for arrive in slices:
        arrive()
        keyed.start_append(keyed.distinct_within(stream, "event_id", "ts", "3 days"), folder, checkpoint).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(folder)
