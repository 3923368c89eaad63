"""Unions, explodes and moved values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union by name; with ``allow_missing`` columns that a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def explode_string_column(
    df: DataFrame,
    column: str,
    separator: str = ",",
    new_column: str | None = None,
    keep_old_column: bool = False,
) -> DataFrame:
    """One row per part of a text split by a separator regex; null texts give no row.

    The split array stays in ``column`` when a new column is named and the old one kept.
    """
    target = new_column or column
    exploded = df.withColumn(column, F.split(F.col(column), separator)).withColumn(target, F.explode(column))
    return exploded.drop(column) if target != column and not keep_old_column else exploded


def explode_array(df: DataFrame, column: str, new_column: str, lower: bool = False) -> DataFrame:
    """One row per array element in place of the array."""
    exploded = df.withColumn("__element", F.explode(column)).drop(column).withColumnRenamed("__element", new_column)
    return exploded.withColumn(new_column, F.lower(new_column)) if lower else exploded


def explode_map_of_lists(
    df: DataFrame, column: str, key_column: str, value_column: str, keep: list[str]
) -> DataFrame:
    """Distinct (kept columns, key, list element) rows of a map of lists."""
    entries = df.select(*keep, F.explode(column).alias(key_column, "__list"))
    return entries.select(*keep, key_column, F.explode("__list").alias(value_column)).distinct()


def move_values_between_columns(df: DataFrame, wrong: Column, target: str, source: str) -> DataFrame:
    """In the rows where ``wrong`` holds, move the value of ``source`` to ``target`` and empty ``source``."""
    hit = F.coalesce(wrong, F.lit(False))
    # Plain select: both columns see the values from before the move.
    moved = {
        target: F.when(hit, F.col(source)).otherwise(F.col(target)),
        source: F.when(~hit, F.col(source)),
    }
    return df.select(*[moved[c].alias(c) if c in moved else F.col(c) for c in df.columns])


def add_not_found_rows(
    answered: DataFrame, requested: DataFrame, key: str, flag: str = "is_scraped", marker: int = -1
) -> DataFrame:
    """Add a row with the marker and nulls for every requested key that has no answer."""
    missing = requested.select(key).distinct().join(answered.select(key), key, "left_anti")
    return answered.unionByName(missing.withColumn(flag, F.lit(marker)), allowMissingColumns=True)
