"""Dates, durations, years and local times."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.functions.text import as_column
from reelsift.functions.values import map_literal
from reelsift.lookups import COUNTRY_ZONES


def _date_when(column: Column, shape: str, layout: str) -> Column:
    # The shape guard keeps one layout from reading text meant for another.
    return F.when(column.rlike(shape), F.try_to_timestamp(column, F.lit(layout)).cast("date"))


def long_date(column: str | Column) -> Column:
    """Date from text such as ``September 9, 2019``; unreadable text gives null."""
    return F.try_to_timestamp(as_column(column), F.lit("MMMM d, yyyy")).cast("date")


def convert_date_format(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, long_date(column))


def release_date(column: str | Column) -> Column:
    """Date from ``2020-01-02``, ``2020``, ``15 Jun 2012`` or ``Jun 2012``, after dropping a trailing ``(...)``."""
    plain = F.regexp_replace(as_column(column), r"\s*\(.*\)", "")
    return F.coalesce(
        _date_when(plain, r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        _date_when(plain, r"^\d{4}$", "yyyy"),
        _date_when(plain, r"^\d{2} [A-Za-z]{3} \d{4}$", "dd MMM yyyy"),
        _date_when(plain, r"^[A-Za-z]{3} \d{4}$", "MMM yyyy"),
    )


def iso8601_to_time(column: str | Column) -> Column:
    """``P1DT2H3M4S`` as ``1.02:03:04``. Parts may be missing; without the ``T`` the result is null.

    Digits stay text all the way, so durations of any length keep their value.
    """
    value = as_column(column)
    pattern = r"^P(?:(\d+)D)?T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?"
    # All parts at once, each behind enough zeros; then the zeros that are too many go.
    parts = F.regexp_replace(value, pattern + "(?s:.*)", "0$1.00$2:00$3:00$4")
    text = F.regexp_replace(parts, r"^0+(?=\d+\.)|(?<=[.:])0+(?=\d\d)", "")
    return F.when(value.rlike(pattern), text)


def to_local_time(utc: Column, country: Column, zones: dict[str, str] | None = None) -> Column:
    """Wall-clock time in the zone of ``country``; unknown countries keep the UTC time, null stays null."""
    zone = map_literal(zones or COUNTRY_ZONES)[country]
    local = F.convert_timezone(F.lit("UTC"), zone, utc.cast("timestamp_ntz"))
    return F.coalesce(local, utc.cast("timestamp_ntz"))


def convert_to_local_time(
    df: DataFrame, utc_column: str, country_column: str, new_column: str, zones: dict[str, str] | None = None
) -> DataFrame:
    return df.withColumn(new_column, to_local_time(F.col(utc_column), F.col(country_column), zones))


def truncate_time(df: DataFrame, column: str, period: str) -> Column:
    """Start of the year, month or day that holds ``column``, in the type of the column."""
    start = F.date_trunc(period, F.col(column))
    kind = df.schema[column].dataType
    return start if isinstance(kind, T.TimestampType) else start.cast(kind)


def run_date(value: str | date | None = None) -> Column:
    """The given run date, or today's."""
    return F.current_date() if value is None else F.lit(str(value)).cast("date")


def digits_to_int(column: str | Column) -> Column:
    """The digits of the text as one integer; null when there are none."""
    return F.regexp_replace(as_column(column), r"\D+", "").try_cast("int")


def split_duration(
    df: DataFrame,
    column: str = "duration",
    category: str = "category",
    minutes: str = "duration_minutes",
    seasons: str = "duration_seasons",
) -> DataFrame:
    """Replace a duration text by minutes (movies) and seasons (shows)."""
    amount = digits_to_int(column)
    return df.withColumns(
        {
            minutes: F.when(F.col(category) == "Movie", amount),
            seasons: F.when(F.col(category) == "TV Show", amount),
        }
    ).drop(column)


def split_series_years(
    df: DataFrame,
    column: str = "series_years",
    first: str = "first_series_years",
    last: str = "last_series_years",
) -> DataFrame:
    """Replace ``2011-2019`` by two years; an open or single year leaves the last one null."""
    parts = F.split(F.col(column), "-")
    return df.withColumns(
        {
            first: F.get(parts, F.lit(0)).try_cast("int"),
            last: F.get(parts, F.lit(1)).try_cast("int"),
        }
    ).drop(column)
