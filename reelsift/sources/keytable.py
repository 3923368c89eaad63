"""Persistent ids: a table that gives every value one id, and never another one.

The table only grows. A slice brings its distinct values; those the table knows keep their id, the others are appended in
files of their own, so a day costs what its new values cost. It is partitioned by a hash of the value, and a slice's
values meet the table's within their partition.

* ``dense`` ids go on from the highest that is given, new values in order.
* ``hashed`` ids are the value's hash, so most ids need no lookup. Where another value has that id already, the value takes its second
  hash, then its third; the table says which ``attempt`` gave the id, and only values beyond the first are looked up.

One writer at a time. A run that ended half-way has appended all its rows or none, and can be repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift.operators.dedup import drop_duplicates_by_ordered_partition
from reelsift.operators.ranking import global_row_number
from reelsift.session import durable, table_root

PART = "key_part"
#: Exceptions that are sent to all tasks at most; more are joined by a shuffle.
SENT_ROWS = 200_000


def nth_hash(value: Column, attempt: int) -> Column:
    """The id of a value at an attempt: its plain hash first, so it equals :func:`hashed_id`."""
    return F.xxhash64(value) if attempt == 0 else F.xxhash64(value, F.lit(attempt))


class KeyTable:
    """Ids of the values of one column, kept in the table ``name``: ``value``, ``id``, ``attempt``."""

    def __init__(
        self, spark: SparkSession, name: str, ids: str = "dense", parts: int = 16, base_path: str | None = None,
        hashes: Callable[[Column, int], Column] = nth_hash,
    ):
        """``parts`` is fixed when the table is made: about the rows expected, divided by a few million."""
        if ids not in ("dense", "hashed"):
            raise ValueError(f"ids are dense or hashed, not {ids}")
        self.spark, self.name, self.hashes = spark, name, hashes
        if not spark.catalog.tableExists(name):
            folder = f"{base_path}/{name}" if base_path else table_root(spark, name)
            spark.sql(
                f"CREATE TABLE {name} (value string, id bigint, attempt int, {PART} int) USING parquet PARTITIONED BY ({PART}) "
                f"LOCATION '{folder}' TBLPROPERTIES ('key_parts' = '{parts}', 'key_ids' = '{ids}')"
            )
        self.parts, self.ids = int(self._property("key_parts")), self._property("key_ids")
        if self.ids != ids:
            raise ValueError(f"the ids of {name} are {self.ids}")

    def _property(self, key: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.name} ('{key}')").first().value

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def highest(self) -> int:
        """The highest id given; read from the files' statistics where the format has them."""
        return self.rows().agg(F.max("id")).first()[0] or 0

    def _with_part(self, values: DataFrame) -> DataFrame:
        return values.withColumn(PART, F.pmod(F.xxhash64("value"), F.lit(self.parts)).cast("int"))

    def extend(self, values: DataFrame, column: str) -> DataFrame:
        """Give an id to each value of ``column`` that has none, and return ``value, id`` of all the column's values.

        Null is no value. Values are compared as text, byte by byte.
        """
        asked = durable(self._with_part(values.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL").distinct()))
        new = durable(asked.join(self.rows().select("value", PART), ["value", PART], "left_anti"))
        if not new.isEmpty():
            given = self._numbered(new) if self.ids == "dense" else self._hashed(new)
            self._append(given)
        return asked.join(self.rows(), ["value", PART]).select("value", "id")

    def _numbered(self, new: DataFrame) -> DataFrame:
        first = self.highest()
        return global_row_number(new, "value", "_nth").select("value", (F.col("_nth") + first).alias("id"), F.lit(0).alias("attempt"), PART)

    def _hashed(self, new: DataFrame) -> DataFrame:
        """Attempt after attempt; the values that are left get fewer by the share of hashes that meet."""
        taken, left, attempt, given = self.rows().select("id"), new, 0, None
        while True:
            tried = left.withColumn("id", self.hashes(F.col("value"), attempt))
            free = tried.join(taken, "id", "left_anti")
            # Of new values with one hash the least keeps it.
            kept = durable(drop_duplicates_by_ordered_partition(free, "id", "value").select("value", "id", F.lit(attempt).alias("attempt"), PART))
            given = kept if given is None else given.unionByName(kept)
            left = durable(left.join(kept.select("value", PART), ["value", PART], "left_anti"))
            if left.isEmpty():
                return durable(given)
            taken, attempt = taken.unionByName(kept.select("id")), attempt + 1

    def _append(self, given: DataFrame) -> None:
        rows = durable(given).select("value", F.col("id").cast("bigint").alias("id"), F.col("attempt").cast("int").alias("attempt"), PART)
        rows.hint("rebalance", F.col(PART)).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def with_ids(self, df: DataFrame, column: str, id_column: str) -> DataFrame:
        """``df`` with the id of ``column``; null where the value is null or not in the table.

        Hashed ids are computed; only the exceptions among them are joined. Then a value that was never given to
        :meth:`extend` gets its plain hash, which may be another value's id.
        """
        value = F.col(column).cast("string")
        if self.ids == "hashed":
            exceptions = durable(self.rows().where("attempt > 0").select(F.col("value").alias("_value"), F.col("id").alias("_id")))
            exceptions = F.broadcast(exceptions) if exceptions.count() <= SENT_ROWS else exceptions
            joined = df.join(exceptions, value == F.col("_value"), "left")
            plain = F.when(value.isNotNull(), self.hashes(value, 0))
            return joined.withColumn(id_column, F.coalesce("_id", plain)).drop("_value", "_id")
        known = self.rows().select(F.col("value").alias("_value"), F.col("id").alias(id_column))
        return df.join(known, value == F.col("_value"), "left").drop("_value")

    def dimension(self, name: str, id_name: str) -> DataFrame:
        return self.rows().select(F.col("value").alias(name), F.col("id").alias(id_name))
