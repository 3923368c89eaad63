"""Lookup, override and replacement joins.

Lookup sides carry no broadcast hint: the planner broadcasts a side whose size it knows to be below
its threshold, and shuffles otherwise, where adaptive execution splits hot keys. It does not know the size of a
partitioned table of the catalogue; such a dimension is counted (``counted``) and then sent if it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of one 8-byte key that may be broadcast once they are counted: some 100 MB as a hash table.
BROADCAST_ROWS = 2_000_000
#: Rows of a dimension, with its columns, that may be broadcast once they are counted.
DIMENSION_ROWS = 200_000


def map_column(df: DataFrame, mapping: DataFrame, mapped_column: str, join_column: str) -> DataFrame:
    """Replace ``join_column`` by what ``mapping`` has for it; values it lacks become null."""
    order = [c for c in df.columns]
    joined = df.join(mapping.select(join_column, mapped_column), join_column, "left")
    return joined.withColumn(join_column, F.col(mapped_column)).select(*order)


def override_column(df: DataFrame, corrections: DataFrame, key: str, column: str, correction: str) -> DataFrame:
    """Take the correction for the rows that have one."""
    order = df.columns
    joined = df.join(corrections.select(key, correction), key, "left")
    return joined.withColumn(column, F.coalesce(correction, column)).select(*order)


def replace_rows(df: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Put the changed rows in place of the rows with their keys; columns are matched by name.

    A column whose type differs between the two raises instead of being skipped.
    """
    conflicts = [
        f.name for f in df.schema.fields
        if f.name in changed.columns and changed.schema[f.name].dataType != f.dataType
    ]
    if conflicts:
        raise ValueError(f"column types differ: {conflicts}")
    return df.join(changed.select(key), key, "left_anti").unionByName(changed)


def dimension_lookup(df: DataFrame, dimension: DataFrame, key: str, columns: list[str], how: str = "left", counted: bool = False) -> DataFrame:
    """Add the named columns of a dimension by its key.

    With ``counted`` the dimension's rows are counted, and broadcast if they are at most ``DIMENSION_ROWS``: then the rows of a key that
    many have are not gathered and sorted in one task. It is for written tables, of which a count reads no column.
    """
    dimension = dimension.select(key, *columns)
    if counted and dimension.count() <= DIMENSION_ROWS:
        dimension = F.broadcast(dimension)
    return df.join(dimension, key, how)
