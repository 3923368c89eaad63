"""Session settings the library relies on, and where its intermediate data may live."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split into several tasks even when that costs one more shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Times without a zone are taken as UTC.
SESSION_SETTINGS = {**SCALE_SETTINGS, "spark.sql.session.timeZone": "UTC"}


def build_session(app_name: str = "reelsift", master: str | None = None, **settings: str) -> SparkSession:
    """Build a session with the scale settings; keyword arguments (dots as ``__``) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SESSION_SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_scale_settings(spark: SparkSession) -> SparkSession:
    """Set the scale settings on a session that somebody else built."""
    for name, value in SCALE_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@cache
def _local_root() -> str:
    """One temporary folder for all that this process writes."""
    return tempfile.mkdtemp(prefix="reelsift-")


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


def table_root(spark: SparkSession, table: str) -> str:
    """Where a table's own data goes if nobody says: beside its database's tables, not among intermediate results."""
    database, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{name}__data"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there.

    What follows reads one fixed result, however often it does and whichever executors are lost. As a
    parquet table it can be split anew, read by column and sized by the planner.
    """
    spark = df.sparkSession
    folder = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
