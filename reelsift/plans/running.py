"""Marts kept up by slices: sums per period that are merged, so the facts of other days are not read again.

A slice of trending rows is reduced to one row per period, video, country and month: counts and sums that add up, and the
earliest row. These rows are a table partitioned by period, and every mart is computed from it. A slice brings whole
periods, whose rows replace what the table had of them, so a corrected day is right without subtracting anything and
the same slice again changes nothing; or it brings more rows of periods, which are added to theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelsift import lookups
from reelsift.functions.values import ratio
from reelsift.operators import stats
from reelsift.operators.ranking import top_k_per_group
from reelsift.plans import marts
from reelsift.session import durable
from reelsift.sources import writers

KEYS = ["period", "month", "video_id", "country_dataset"]
_MEASURES = ("views", "likes", "rate")
_DATE_UNITS = ("year", "quarter", "month", "week")
_READ = ["video_id", "trending_date", "country_dataset", "view_count", "likes"]


def _first() -> Column:
    """A row's place among its video's rows, and its figures: earliest, then country, then most views and likes."""
    views, likes = F.col("view_count").cast("bigint"), F.col("likes").cast("bigint")
    place = [F.col("trending_date").alias("at"), F.col("country_dataset").alias("country"), views.isNull().alias("no_views"), (-views).alias("less_views")]
    return F.struct(*place, likes.isNull().alias("no_likes"), (-likes).alias("less_likes"))


def _least_first(keys: list[str]) -> Column:
    """The smallest ``first``, without the country where the group has but one."""
    return F.min(F.col("first").dropFields("country") if "country_dataset" in keys else F.col("first")).alias("first")


class TrendingState:
    """The table ``database.table`` of merged sums, and the marts out of it."""

    def __init__(self, spark: SparkSession, database: str, table: str, period: str = "day", min_views: int = 1_000_000):
        """``min_views`` is what a row needs to count for tags; the sums depend on it, so it is fixed with the table."""
        self.spark, self.database, self.table = spark, database, table
        self.name, self.period, self.min_views = f"{database}.{table}", period, min_views

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def _dated(self, trending: DataFrame) -> DataFrame:
        """What is read of ``trending``, with its period and month."""
        day = F.col("trending_date").cast("timestamp").cast("date")
        # Of dates, where the unit is one of dates: that is cheaper than of times.
        period = F.trunc(day, self.period) if self.period.lower() in _DATE_UNITS else F.date_trunc(self.period, F.col("trending_date")).cast("date")
        return trending.select(*_READ).withColumns({"period": period, "month": F.trunc(day, "month")})

    def _each(self, dated: DataFrame) -> DataFrame:
        """The row of the table that each row amounts to."""
        counted = F.coalesce(F.col("view_count") > self.min_views, F.lit(False))
        measures = {"views": F.col("view_count").cast("double"), "likes": F.col("likes").cast("double"), "rate": ratio("likes", "view_count")}
        return dated.select(
            *KEYS, F.lit(1).cast("bigint").alias("rows"), counted.cast("bigint").alias("n"),
            *[F.when(counted, m).alias(f"{name}_sum") for name, m in measures.items()],
            *[(counted & m.isNotNull()).cast("bigint").alias(f"{name}_n") for name, m in measures.items()],
            _first().alias("first"),
        )

    def summed(self, trending: DataFrame) -> DataFrame:
        """The rows of the table that ``trending`` amounts to."""
        return self._merged(self._each(self._dated(trending)), KEYS)

    def absorb(self, trending: DataFrame, whole_periods: bool = True) -> None:
        """Take in a slice: periods that it holds as a whole, or more rows of them (``whole_periods=False``; not to be repeated)."""
        if whole_periods or not self.spark.catalog.tableExists(self.name):
            new = self.summed(trending)
        else:
            # Written before they are summed: the periods come from the same rows, and these are summed once, together with the table's.
            dated = durable(self._dated(trending))
            # One row per period of the slice.
            touched = [r.period for r in dated.select("period").distinct().collect()]
            # Partitions are read while their successors are written: a dynamic overwrite replaces them when all tasks have ended.
            new = self._merged(self.rows().where(F.col("period").isin(touched)).unionByName(self._each(dated)), KEYS)
        writers.save_to_db2(new, self.database, self.table, ["period"])
        self.spark.catalog.refreshTable(self.name)

    @staticmethod
    def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
        sums = ["rows", "n", *[f"{m}_{kind}" for kind in ("sum", "n") for m in _MEASURES]]
        # The video goes first: the smallest struct takes a sort by the keys, which then mostly compares one number.
        merged = rows.groupBy(*sorted(keys, key=lambda k: k != "video_id")).agg(*[F.sum(c).alias(c) for c in sums], _least_first(keys))
        if "country_dataset" in keys:
            first = [F.col("country_dataset").alias("country") if f == "country" else F.col(f"first.{f}") for f in rows.schema["first"].dataType.names]
            merged = merged.withColumn("first", F.struct(*first))
        return merged.select(*keys, *sums, "first")

    def tag_statistics(self, bridge: DataFrame, tags: DataFrame, min_videos: int = 100, exclude: str = lookups.OTHER_TAG) -> DataFrame:
        """:func:`marts.tag_statistics` of all periods."""
        earliest = self.rows().groupBy("video_id").agg(F.min("first").alias("first"))
        first = earliest.select("video_id", (-F.col("first.less_views")).alias("view_count"), (-F.col("first.less_likes")).alias("likes"))
        partials = marts.partial_sums(first.where(F.col("view_count") > self.min_views), ["video_id"])
        return marts.tag_means(partials, bridge, tags, [], exclude).where(F.col("videos_count") > min_videos)

    def top_tags_per_country(self, bridge: DataFrame, tags: DataFrame, k: int = 25, exclude: str = lookups.OTHER_TAG) -> DataFrame:
        """:func:`marts.top_tags_per_country` of all periods."""
        partials = self._merged(self.rows().where("n > 0"), ["video_id", "country_dataset"]).drop("rows", "first")
        means = marts.tag_means(partials, bridge, tags, ["country_dataset"], exclude)
        return top_k_per_group(means, "country_dataset", [F.col("videos_count").desc(), F.col("tag").asc()], k, "tag_country_rank")

    def _per_category(self, videos: DataFrame, keys: list[str], count: str) -> DataFrame:
        per_video = self.rows().groupBy("video_id", *keys).agg(F.sum("rows").alias("rows"))
        named = per_video.join(videos.select("video_id", "category_name"), "video_id", "left")
        return named.groupBy("category_name", *keys).agg(F.sum("rows").alias(count))

    def category_distribution(self, videos: DataFrame) -> DataFrame:
        """:func:`marts.category_distribution` of all periods."""
        count = "videos_in_category_per_country"
        counts = self._per_category(videos, ["country_dataset"], count)
        return stats.share_per_scope(counts, "country_dataset", "category_name", count, "percent_of_country_trending_videos")

    def monthly_category_distribution(self, videos: DataFrame) -> DataFrame:
        """:func:`marts.monthly_category_distribution` of all periods; the month is a date."""
        return self._per_category(videos, ["country_dataset", "month"], "videos_in_category_per_month")
