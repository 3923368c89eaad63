"""Cleaning plans: raw catalogue, enriched catalogue, trending videos."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift import lookups
from reelsift.functions.dates import convert_date_format, iso8601_to_time, release_date, run_date as run_date_column
from reelsift.functions.dates import split_duration, split_series_years
from reelsift.functions.money import box_office_to_eur
from reelsift.functions.rules import apply_per_distinct, cascade
from reelsift.functions.text import keyword_flag, strip_leading_comma
from reelsift.functions.values import convert_string_boolean_to_int
from reelsift.operators.dedup import drop_duplicates_by_ordered_partition, latest_per_key, total_order
from reelsift.operators.joins import map_column, override_column
from reelsift.operators.quality import keep_at_least, remove_values_by_prefix
from reelsift.operators.reshape import move_values_between_columns
from reelsift.operators.schema import (
    convert_bool_columns_to_int,
    ensure_column_existence,
    ensure_list_column,
    merge_schema_into_dataframe,
)
from reelsift.schemas import VIDEO_ENRICHED
from reelsift.sources.readers import ALL_DATES, inline_table, slice_by_date

CATALOGUE_COLUMNS = [
    "show_id", "category", "age_required", "title", "director", "cast", "countries", "date_added",
    "release_year", "duration", "genres", "is_animation", "platform", "is_scraped", "last_updated_date",
]


def clean_raw_catalogue(
    raw: DataFrame,
    ratings: DataFrame | None = None,
    overrides: DataFrame | None = None,
    file_date: str = ALL_DATES,
    removed_prefixes: list[str] = lookups.WORKOUT_PREFIXES,
) -> DataFrame:
    """Raw catalogue rows to one clean row per title, ready for the upsert.

    ``ratings`` maps ``age_required`` codes to ``min_age``; ``overrides`` maps ``show_id`` to
    ``title_translation``. Of the rows with one title the least ``show_id`` stays.
    """
    spark = raw.sparkSession
    if ratings is None:
        ratings = inline_table(spark, list(lookups.RATING_CODES.items()), ["age_required", "min_age"])
    if overrides is None:
        overrides = inline_table(spark, list(lookups.TITLE_OVERRIDES.items()), ["show_id", "title_translation"])

    dated = ensure_column_existence(raw, "last_updated_date", "date")
    dated = dated.withColumn("last_updated_date", F.col("last_updated_date").cast("date"))
    rows = slice_by_date(dated, file_date).withColumn("countries", strip_leading_comma("countries"))
    rows = move_values_between_columns(rows, F.col("age_required").contains("min"), "duration", "age_required")
    rows = override_column(rows, overrides, "show_id", "title", "title_translation")
    rows = map_column(rows, ratings, "min_age", "age_required")
    rows = rows.withColumn("age_required", F.col("age_required").cast("int"))
    rows = remove_values_by_prefix(rows, "title", removed_prefixes)
    rows = rows.withColumns(
        {
            "is_animation": keyword_flag("genres", ["Animation", "Anime Series"]),
            "is_scraped": F.lit("No"),
        }
    )
    rows = convert_date_format(rows, "date_added").select(*CATALOGUE_COLUMNS)
    return drop_duplicates_by_ordered_partition(rows, "title", "show_id")


def clean_enriched_catalogue(
    enriched: DataFrame,
    rates: DataFrame | None = None,
    genre_rules: list[lookups.Rule] = lookups.CATALOGUE_GENRE_RULES,
    file_date: str = ALL_DATES,
    run_date: str | date | None = None,
    minimum_budget: float = 10,
) -> DataFrame:
    """Enriched catalogue rows to typed values: dates, durations, years, euro amounts, one genre label.

    Of the rows with one title on one platform the least ``show_id`` stays.
    """
    rows = slice_by_date(enriched, file_date)
    # Labels first: they depend on the genres alone, and only the genres are read for them.
    rows = apply_per_distinct(rows, "genres", "genres", lambda genres: cascade(genres, genre_rules))
    if "release_year" in rows.columns:
        rows = rows.withColumnRenamed("release_year", "release_date")
    rows = rows.withColumns(
        {
            "release_date": release_date(F.col("release_date").cast("string")),
            "rating": F.round(F.col("rating").try_cast("double"), 2),
        }
    )
    if "duration" in rows.columns:
        rows = split_duration(rows)
    if "series_years" in rows.columns:
        rows = split_series_years(rows)
    if "box_office" in rows.columns:
        rows = keep_at_least(box_office_to_eur(rows, "box_office", rates), "budget_eur", minimum_budget)
    rows = drop_duplicates_by_ordered_partition(rows, ["title", "platform"], "show_id")
    return rows.withColumn("last_updated_date", run_date_column(run_date))


def _clean_trending_columns(raw: DataFrame) -> DataFrame:
    return ensure_list_column(raw.withColumnsRenamed(lookups.VIDEO_RENAMES), "tags", r"\|", lookups.NO_TAGS)


def _by_views(keep_highest: bool, rows: DataFrame) -> list:
    """By views, likes and comments, and then by all columns, so that the row kept is always the same."""
    views = F.col("view_count")
    first = views.desc_nulls_last() if keep_highest else views.asc()
    return [first, F.col("likes").desc_nulls_last(), F.col("comment_count").desc_nulls_last(), *total_order(rows)]


def trending_initial_cleaning(raw: DataFrame, keep_highest: bool = True) -> DataFrame:
    """Clean names and types, and one row per video, trending date and country.

    The row with the most views stays, or with ``keep_highest=False`` the one with the fewest.
    """
    keys = ["video_id", "trending_date", "country_dataset"]
    cleaned = _clean_trending_columns(raw)
    rows = drop_duplicates_by_ordered_partition(cleaned, keys, _by_views(keep_highest, cleaned))
    return convert_bool_columns_to_int(rows)


def latest_videos(raw: DataFrame, keep_highest: bool = True) -> DataFrame:
    """The latest row of each video after :func:`trending_initial_cleaning`, found in one pass.

    The row that cleaning keeps of the latest day is the first of the video in this order.
    """
    rows = _clean_trending_columns(raw)
    return latest_per_key(rows, "video_id", "trending_date", ["country_dataset", *_by_views(keep_highest, rows)])


def merged_videos(raw: DataFrame, keep_highest: bool = True) -> DataFrame:
    """One row per video over all countries: its latest trending row, with the columns still to be enriched."""
    pending = ensure_column_existence(raw, "is_scraped", "int", 0)
    return merge_schema_into_dataframe(latest_videos(pending, keep_highest), VIDEO_ENRICHED)


def silver_videos(trending: DataFrame, enriched: DataFrame) -> DataFrame:
    """Latest trending facts of each video next to its enriched details, with durations and flags normalised."""
    base = latest_videos(trending)
    facts = [
        "channel_id", "title", "channel_title", "published_at", "category_name", "thumbnail_link",
        "comments_disabled", "ratings_disabled",
    ]
    details = [
        "tags", "is_scraped", "default_language", "duration", "caption", "licensed_content",
        "region_restriction", "content_rating",
    ]
    left, right = base.alias("fact"), enriched.alias("detail")
    joined = left.join(right, F.col("fact.video_id") == F.col("detail.video_id")).select(
        "fact.video_id", *[f"fact.{c}" for c in facts], *[f"detail.{c}" for c in details]
    )
    timed = joined.withColumn("duration", iso8601_to_time("duration"))
    return convert_bool_columns_to_int(convert_string_boolean_to_int(timed, "caption"))
