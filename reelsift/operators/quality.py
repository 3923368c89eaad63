"""Row filters and data-quality counts."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.text import as_list
from reelsift.lookups import NON_LATIN_BLOCKS, NOT_A_TRAILER_TERMS
from reelsift.operators.bloom import BloomFilter


def select_rows_with_missing_values(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with a null in any of the columns (all columns by default)."""
    return df.where(reduce(or_, [F.col(c).isNull() for c in columns or df.columns]))


def count_na(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the number of nulls per column, as ``<column>_na``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_na") for c in columns or df.columns])


def drop_missing_character(
    df: DataFrame,
    columns: str | list[str],
    full_string: bool = True,
    keep_nulls: bool = False,
    ascii_words: bool = False,
) -> DataFrame:
    """Drop rows whose value is nothing but replacement characters and non-word characters.

    With ``full_string=False`` one replacement character is enough. Letters of every script count as
    word characters unless ``ascii_words``. Null cells are dropped too unless ``keep_nulls``.
    """
    unicode_flag = "" if ascii_words else "(?U)"
    junk = unicode_flag + "^[�\\W]+$" if full_string else "�+"
    conditions = [~F.coalesce(F.col(c).rlike(junk), F.lit(not keep_nulls)) for c in as_list(columns)]
    return df.where(reduce(and_, conditions))


def regexp_match_count(df: DataFrame, columns: list[str], pattern: str) -> DataFrame:
    """Rows matching per column, in all columns and in any column, from one pass."""
    hits = [F.col(c).rlike(pattern) for c in columns]
    return df.agg(
        *[F.count_if(hit).alias(f"{c}_count") for c, hit in zip(columns, hits)],
        F.count_if(reduce(and_, hits)).alias("all_columns_match_count"),
        F.count_if(reduce(or_, hits)).alias("any_column_match_count"),
    )


def any_of(patterns: list[str]) -> str:
    """One pattern that matches where any of the patterns does."""
    return "|".join(f"(?:{pattern})" for pattern in patterns)


def filter_with_regex_list(
    df: DataFrame, column: str, patterns: list[str] | None = None, reverse_match: bool = False
) -> DataFrame:
    """Rows matching any pattern, or none with ``reverse_match``; no patterns means no filter."""
    if not patterns:
        return df
    hit = F.col(column).rlike(any_of(patterns))
    return df.where(~hit if reverse_match else hit)


def filter_non_english_values(
    df: DataFrame, patterns: list[str] | None = None, exclude_non_english: bool = False, column: str = "title"
) -> DataFrame:
    """Rows whose title has characters of the given blocks, or the other rows."""
    return filter_with_regex_list(df, column, patterns or NON_LATIN_BLOCKS, exclude_non_english)


def remove_values_by_prefix(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Drop rows whose value starts with any of the literal prefixes; null values go as well. No prefixes means no filter."""
    if not prefixes:
        return df
    return df.where(~reduce(or_, [F.col(column).startswith(prefix) for prefix in prefixes]))


def filter_date_range(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def filter_date_year(df: DataFrame, column: str, year: int) -> DataFrame:
    """Rows of a whole calendar year, up to its last instant."""
    return df.where((F.col(column) >= F.lit(f"{year}-01-01")) & (F.col(column) < F.lit(f"{year + 1}-01-01")))


def keep_at_least(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """Rows at or above the minimum, and rows without a value."""
    return df.where((F.col(column) >= minimum) | F.col(column).isNull())


def trailer_condition(
    title: Column,
    category: Column,
    keyword: str = "trailer",
    stop_terms: list[str] = NOT_A_TRAILER_TERMS,
    excluded_categories: tuple[str, ...] = ("Gaming",),
) -> Column:
    """Titles with the keyword, without any stop term as a whole word, outside the excluded categories."""
    stop = rf"(?iu)(?U)\b({'|'.join(stop_terms)})\b"
    return (
        F.lower(title).contains(keyword)
        & ~title.rlike(stop)
        & ~F.lower(category).isin([name.lower() for name in excluded_categories])
    )


def keep_members(df: DataFrame, column: str, members: DataFrame, prefilter: bool = False) -> DataFrame:
    """Rows whose value occurs in the first column of ``members``.

    For members that are too many to send, ``prefilter`` drops most of the other rows by a Bloom filter before they are shuffled.
    """
    if prefilter:
        df = BloomFilter(members, members.columns[0]).may_hold(df, column)
    return df.join(members.select(F.col(members.columns[0]).alias(column)), column, "left_semi")


def drop_members(df: DataFrame, column: str, members: DataFrame) -> DataFrame:
    """Rows whose value does not occur in the first column of ``members``; null values go as well."""
    listed = members.select(F.col(members.columns[0]).alias(column))
    return df.where(F.col(column).isNotNull()).join(listed, column, "left_anti")


def flag_members(df: DataFrame, column: str, members: DataFrame, flag: str) -> DataFrame:
    """1 when the value occurs in the first column of ``members``, else 0."""
    listed = members.select(F.col(members.columns[0]).alias(column)).distinct().withColumn(flag, F.lit(1))
    return df.join(listed, column, "left").na.fill(0, subset=[flag])
