"""One row per key, duplicates and key-value lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions.text import as_list


def drop_duplicates_by_ordered_partition(
    df: DataFrame, partition_by: str | Column | list, order_by: str | Column | list
) -> DataFrame:
    """First row of each key in the given order.

    The filter sits directly on the row number, so Spark keeps one row per key and map task before
    the shuffle; a key that holds a large part of the rows reaches its task as a handful of them.
    """
    window = Window.partitionBy(*as_list(partition_by)).orderBy(*as_list(order_by))
    return df.withColumn("__position", F.row_number().over(window)).where("__position = 1").drop("__position")


def _has_map(kind: T.DataType) -> bool:
    inner = {T.MapType: ("keyType", "valueType"), T.ArrayType: ("elementType",)}.get(type(kind), ())
    parts = [getattr(kind, name) for name in inner] or ([f.dataType for f in kind.fields] if isinstance(kind, T.StructType) else [])
    return isinstance(kind, T.MapType) or any(_has_map(p) for p in parts)


def total_order(df: DataFrame, leaving: tuple[str, ...] = ()) -> list[Column]:
    """All columns as sort keys. Maps, which have no order, go by their sorted entries, or by their text when nested."""
    keys = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType) and not _has_map(field.dataType.valueType):
            column = F.array_sort(F.map_entries(column))
        elif _has_map(field.dataType):
            column = F.to_json(F.struct(column))
        if field.name not in leaving:
            keys.append(column)
    return keys


def latest_per_key(df: DataFrame, key: str | list[str], time: str, tie_breakers: list | None = None) -> DataFrame:
    return drop_duplicates_by_ordered_partition(df, key, [F.col(time).desc(), *(tie_breakers or [])])


def earliest_per_key(df: DataFrame, key: str | list[str], time: str, tie_breakers: list | None = None) -> DataFrame:
    return drop_duplicates_by_ordered_partition(df, key, [F.col(time).asc(), *(tie_breakers or [])])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def display_duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    return df.groupBy(column).agg(F.count("*").alias("count")).where(F.col("count") > 1)


def key_value_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value (the least) per key, without null keys or values, ready for a lookup join."""
    pairs = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    return pairs.groupBy(key).agg(F.min(value).alias(value))
