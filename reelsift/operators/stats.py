"""Grouped counts, means, shares, pivots, time buckets and coverage reports."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.functions.dates import truncate_time
from reelsift.functions.text import as_list
from reelsift.functions.values import ratio
from reelsift.session import durable


def group_by_count(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Non-null count of every group column, as ``<column>_count``."""
    keys = as_list(columns)
    return df.groupBy(*keys).agg(*[F.count(key).alias(f"{key}_count") for key in keys])


def summarise(
    df: DataFrame, group_by: str | list[str], sums: dict[str, str], means: dict[str, str], count: str
) -> DataFrame:
    """Row count, sums and means (two decimals) per group; dicts map result names to columns."""
    return df.groupBy(*as_list(group_by)).agg(
        F.count("*").alias(count),
        *[F.sum(column).alias(name) for name, column in sums.items()],
        *[F.round(F.avg(column), 2).alias(name) for name, column in means.items()],
    )


def ratio_means(
    df: DataFrame, group_by: str | list[str], numerator: str, denominator: str, names: tuple[str, str, str, str]
) -> DataFrame:
    """Row count, mean denominator, mean numerator and mean quotient per group."""
    count, mean_denominator, mean_numerator, mean_ratio = names
    return df.groupBy(*as_list(group_by)).agg(
        F.count("*").alias(count),
        F.avg(denominator).alias(mean_denominator),
        F.avg(numerator).alias(mean_numerator),
        F.avg(ratio(numerator, denominator)).alias(mean_ratio),
    )


def pivot_counts(df: DataFrame, group_by: str, pivot: str, names: dict[str, str], total: str) -> DataFrame:
    """Rows per group and pivot value as columns, and their sum; values absent from a group stay null.

    ``names`` lists the pivot values with their column names; the total covers those values.
    """
    counted = df.groupBy(group_by).pivot(pivot, list(names)).agg(F.count(F.lit(1)))
    renamed = counted.withColumnsRenamed(names)
    parts = [F.coalesce(F.col(name), F.lit(0)) for name in names.values()]
    return renamed.withColumn(total, reduce(add, parts))


def with_group_total(df: DataFrame, group_by: str, column: str, total: str) -> DataFrame:
    """Add the sum of ``column`` per group to every row.

    A join with the totals rather than a window, so that a large group is not gathered in one task. The rows without
    a group are a group.
    """
    totals = df.groupBy(F.col(group_by).alias("__group")).agg(F.sum(column).alias(total))
    return df.join(totals, F.col(group_by).eqNullSafe(F.col("__group")), "left").drop("__group")


def share_per_scope(
    counts: DataFrame, scope: str, category: str, count: str, share: str, grand_total: str | None = "ALL"
) -> DataFrame:
    """Share of each category in its scope, from counts per (scope, category).

    With ``grand_total`` the categories of all scopes together are added under that name. Each count
    goes to its own scope and to the grand total, and is summed before it is shuffled.
    """
    levels = F.array(F.col(scope), F.lit(grand_total)) if grand_total else F.array(F.col(scope))
    per_scope = (
        counts.withColumn(scope, F.explode(levels)).groupBy(scope, category).agg(F.sum(count).alias(count))
    )
    # Written once: the counts meet their own totals.
    whole = with_group_total(durable(per_scope), scope, count, "__whole")
    return whole.withColumn(share, ratio(count, "__whole")).drop("__whole")


def aggregate_category_distribution_over_time_periods(
    df: DataFrame, group_by: str | list[str], date_column: str, period: str = "month"
) -> DataFrame:
    """Rows per group and year, month or day, as ``count_per_<period>``."""
    bucketed = df.withColumn(period, truncate_time(df, date_column, period))
    return bucketed.groupBy(*as_list(group_by), period).agg(F.count("*").alias(f"count_per_{period}"))


def column_wise_max(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Largest value of every column per key, each on its own; the dict maps columns to result names."""
    return df.groupBy(key).agg(*[F.max(column).alias(name) for column, name in columns.items()])


def flag_summary(df: DataFrame, key: str, flag: str, count: str = "tags_count") -> DataFrame:
    """Rows per key, flagged rows per key, and whether there is any."""
    return df.groupBy(key).agg(
        F.count("*").alias(count),
        F.sum(flag).cast("bigint").alias(f"{flag}_count"),
        F.max(flag).alias(f"has_{flag}"),
    )


def tag_coverage(per_video: DataFrame, videos: DataFrame, tags: str, flag: str) -> DataFrame:
    """Mean tags per video, share of videos with tags, mean top tags and share with a top tag: one row.

    ``per_video`` comes from :func:`flag_summary`; ``videos`` has one row per video. Both are reduced
    to one row before they meet.
    """
    sums = per_video.agg(
        F.sum("tags_count").alias("__tags"),
        F.sum(f"{flag}_count").alias("__flagged"),
        F.sum(f"has_{flag}").alias("__with_flag"),
    )
    totals = videos.agg(F.count("*").alias("__videos"), F.count(tags).alias("__tagged"))
    # One row by one row.
    return totals.crossJoin(sums).select(
        F.col("__videos").alias("total_videos"),
        ratio("__tags", "__videos").alias("average_tags_per_video"),
        ratio("__tagged", "__videos").alias("share_with_tags"),
        ratio("__flagged", "__videos").alias(f"average_{flag}s_per_video"),
        ratio("__with_flag", "__videos").alias(f"share_with_{flag}"),
    )


def histogram(df: DataFrame, column: str, count: str = "count") -> DataFrame:
    """How many rows have each value, in order of the value."""
    return df.groupBy(column).agg(F.count("*").alias(count)).orderBy(column)
