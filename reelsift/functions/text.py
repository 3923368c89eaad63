"""Text clean-up: quotes, prefixes, substrings and keyword flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_list(value) -> list:
    return list(value) if isinstance(value, (list, tuple)) else [value]


def remove_outer_quotes(column: str | Column) -> Column:
    """Strip every double quote at either end."""
    return F.btrim(as_column(column), F.lit('"'))


def strip_field_quotes(column: str | Column) -> Column:
    """Strip one double quote at either end, with the blanks outside it."""
    opened = F.regexp_replace(as_column(column), r'^\s*"', "")
    return F.regexp_replace(opened, r'"\s*$', "")


def strip_leading_comma(column: str | Column) -> Column:
    return F.regexp_replace(as_column(column), r"^,\s+", "")


def remove_quotes_from_country(df: DataFrame, column: str = "countries") -> DataFrame:
    return df.withColumn(column, strip_field_quotes(column))


def replace_unwanted_string_in_column(df: DataFrame, pattern: str, new: str, column: str = "title") -> DataFrame:
    return df.withColumn(column, F.regexp_replace(column, pattern, new))


def change_id_prefix(df: DataFrame, prefix: str, column: str = "show_id", old: str = "s") -> DataFrame:
    """Put ``prefix`` in place of a leading ``old`` in the id column."""
    tail = F.substr(F.col(column), F.lit(len(old) + 1))
    return df.withColumn(
        column, F.when(F.col(column).startswith(old), F.concat(F.lit(prefix), tail)).otherwise(F.col(column))
    )


def truncate_string_columns(
    df: DataFrame, columns: str | list[str], start: int = 1, size: int | None = None
) -> DataFrame:
    """Keep ``size`` characters from ``start`` (1-based), or all the rest when no size is given."""
    length = () if size is None else (F.lit(size),)
    return df.withColumns({c: F.substr(F.col(c), F.lit(start), *length) for c in as_list(columns)})


def keyword_flag(column: str | Column, words: list[str]) -> Column:
    """``yes`` when any word occurs in the value, ``no`` otherwise and for null."""
    hit = F.lit(False)
    for word in words:
        hit = hit | as_column(column).contains(word)
    return F.when(hit, "yes").otherwise("no")
