"""Dimensions and bridges out of list-valued text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.text import as_column
from reelsift.operators.ranking import dense_ids, hashed_id
from reelsift.session import durable


def list_parts(column: str | Column, separator: str = ",", trim: bool = True) -> Column:
    """Parts of a list in a text; with ``trim`` blanks around them are stripped and empty parts dropped."""
    parts = F.split(as_column(column), separator)
    return F.filter(F.transform(parts, lambda part: F.trim(part)), lambda part: part != "") if trim else parts


def create_unique_df(
    df: DataFrame,
    column: str,
    name: str,
    id_name: str,
    separator: str = ",",
    trim: bool = True,
    ids: str = "hash",
) -> DataFrame:
    """Dimension (name, id) of the parts of a list column.

    ``ids="hash"`` computes the id from the name; ``ids="dense"`` numbers the names 1, 2, ... in order.
    """
    parts = F.array_distinct(list_parts(column, separator, trim))
    names = df.select(F.explode(parts).alias(name)).distinct()
    if ids == "dense":
        return dense_ids(names, name, id_name)
    return names.withColumn(id_name, hashed_id(F.col(name)))


def create_association_table(
    df: DataFrame,
    dimension: DataFrame | None,
    column: str,
    name: str,
    left_id: str,
    right_id: str,
    separator: str = ",",
    trim: bool = True,
) -> DataFrame:
    """Bridge (left id, right id). Without a dimension the ids are hashed, and nothing is joined."""
    pairs = df.select(left_id, F.explode(list_parts(column, separator, trim)).alias(name))
    if dimension is None:
        return pairs.select(left_id, hashed_id(F.col(name)).alias(right_id))
    return pairs.join(dimension, name, "left").select(left_id, right_id)


def keyed_dimension_and_bridge(
    df: DataFrame, keys, column: str, name: str, left_id: str, right_id: str, separator: str = ",", trim: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Dimension (name, id) and bridge of a slice, with the ids of a :class:`~reelsift.sources.keytable.KeyTable`.

    Names the table knows keep their id, new ones get theirs and stay in the table, so slices agree with each other.
    """
    pairs = durable(df.select(left_id, F.explode(list_parts(column, separator, trim)).alias(name)))
    dimension = durable(keys.extend(pairs, name).select(F.col("value").alias(name), F.col("id").alias(right_id)))
    return dimension, pairs.join(dimension, name).select(left_id, right_id)
