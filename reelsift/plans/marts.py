"""Analytic marts.

Facts are reduced to partial sums on the join key before they meet the video or tag tables, so a
video or tag that holds a large part of the rows is a few rows by the time anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift import lookups
from reelsift.functions.dates import to_local_time, truncate_time
from reelsift.functions.rules import apply_per_distinct, last_match
from reelsift.functions.values import ratio
from reelsift.operators import match, stats
from reelsift.operators.dedup import earliest_per_key
from reelsift.operators.quality import count_na, flag_members, trailer_condition
from reelsift.operators.ranking import top_k_per_group, top_n
from reelsift.operators.reshape import explode_array
from reelsift.session import durable

FACT_COLUMNS = ["video_id", "trending_date", "country_dataset", "view_count", "likes", "dislikes", "comment_count"]
VIDEO_COLUMNS = [
    "video_id", "channel_id", "title", "published_at", "category_name", "comments_disabled",
    "ratings_disabled", "default_language", "duration", "caption",
]
TRENDING_COLUMNS = [
    "video_id", "title", "channel_title", "trending_date", "UTC_publish_date", "country_dataset",
    "view_count", "likes", "dislikes", "comment_count", "category_name", "comments_disabled",
    "ratings_disabled", "default_language", "duration", "caption", "local_publish_date",
]


def video_details(videos: DataFrame, channels: DataFrame) -> DataFrame:
    """What trending rows take from their video and its channel, one row per video."""
    return videos.select(*VIDEO_COLUMNS).join(channels.select("channel_id", "channel_title"), "channel_id", "left")


def trending_with_details(
    trending: DataFrame, videos: DataFrame, channels: DataFrame | None = None, zones: dict[str, str] | None = None
) -> DataFrame:
    """Trending rows with their video, channel and local publishing time.

    Videos meet their channels before the facts, so the facts are joined once; without ``channels``, ``videos`` are
    :func:`video_details` already. Where both tables are in the same buckets by ``video_id``
    (:func:`~reelsift.sources.writers.publish_cobucketed`) no row is shuffled.
    """
    details = videos if channels is None else video_details(videos, channels)
    joined = trending.select(*FACT_COLUMNS).join(details, "video_id", "left")
    published = F.col("published_at")
    return joined.withColumns(
        {
            "UTC_publish_date": published,
            "local_publish_date": to_local_time(published, F.col("country_dataset"), zones),
        }
    ).select(*TRENDING_COLUMNS)


def video_tags(bridge: DataFrame, tags: DataFrame) -> DataFrame:
    """(video, tag) pairs."""
    return bridge.join(tags, "tag_id", "left").select("video_id", "tag")


def partial_sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Sums and non-null counts of views, likes and likes per view, which add up over further grouping."""
    # As doubles: sums of whole numbers could leave their range.
    measures = {"views": F.col("view_count").cast("double"), "likes": F.col("likes").cast("double"), "rate": ratio("likes", "view_count")}
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(m).alias(f"{name}_sum") for name, m in measures.items()],
        *[F.count(m).alias(f"{name}_n") for name, m in measures.items()],
    )


def _add_up(partials: DataFrame, keys: list[str]) -> DataFrame:
    sums = [c for c in partials.columns if c.endswith(("_sum", "_n")) or c == "n"]
    return partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def tag_means(partials: DataFrame, bridge: DataFrame, tags: DataFrame, keys: list[str], exclude: str) -> DataFrame:
    by_id = _add_up(partials.join(bridge, "video_id"), ["tag_id", *keys])
    named = by_id.join(tags, "tag_id").where(F.col("tag").isNotNull() & (F.col("tag") != exclude))
    return _add_up(named, ["tag", *keys]).select(
        "tag",
        *keys,
        F.col("n").alias("videos_count"),
        ratio("views_sum", "views_n").alias("avg_view_count"),
        ratio("likes_sum", "likes_n").alias("avg_likes_count"),
        ratio("rate_sum", "rate_n").alias("avg_likes_per_view"),
    )


def tag_statistics(
    trending: DataFrame,
    bridge: DataFrame,
    tags: DataFrame,
    min_views: int = 1_000_000,
    min_videos: int = 100,
    exclude: str = lookups.OTHER_TAG,
    tie_breakers: list | None = None,
) -> DataFrame:
    """Per tag: videos with more than ``min_views`` on their first trending day, mean views, likes and likes per view.

    Tags of more than ``min_videos`` such videos. Every tag of a video counts.
    """
    columns = ["video_id", "trending_date", "country_dataset", "view_count", "likes"]
    order = tie_breakers or ["country_dataset", F.col("view_count").desc(), F.col("likes").desc()]
    first = earliest_per_key(trending.select(*columns), "video_id", "trending_date", order)
    partials = partial_sums(first.where(F.col("view_count") > min_views), ["video_id"])
    return tag_means(partials, bridge, tags, [], exclude).where(F.col("videos_count") > min_videos)


def top_tags_per_country(
    trending: DataFrame,
    bridge: DataFrame,
    tags: DataFrame,
    min_views: int = 1_000_000,
    k: int = 25,
    exclude: str = lookups.OTHER_TAG,
    count_videos: bool = False,
) -> DataFrame:
    """The ``k`` tags per country with the most trending rows above ``min_views``, with their means and rank.

    A video counts once for every row it has in a country, or with ``count_videos`` once. Tags with
    equal counts rank by name.
    """
    partials = partial_sums(trending.where(F.col("view_count") > min_views), ["video_id", "country_dataset"])
    if count_videos:
        partials = partials.withColumn("n", F.lit(1).cast("bigint"))
    means = tag_means(partials, bridge, tags, ["country_dataset"], exclude)
    order = [F.col("videos_count").desc(), F.col("tag").asc()]
    return top_k_per_group(means, "country_dataset", order, k, "tag_country_rank")


def category_distribution(trending: DataFrame, videos: DataFrame) -> DataFrame:
    """Rows and share per category in each country, and in all of them as country ``ALL``."""
    per_video = trending.groupBy("video_id", "country_dataset").agg(F.count("*").alias("n"))
    counts = (
        per_video.join(videos.select("video_id", "category_name"), "video_id", "left")
        .groupBy("country_dataset", "category_name")
        .agg(F.sum("n").alias("videos_in_category_per_country"))
    )
    return stats.share_per_scope(
        counts, "country_dataset", "category_name", "videos_in_category_per_country",
        "percent_of_country_trending_videos",
    )


def monthly_category_distribution(trending: DataFrame, videos: DataFrame) -> DataFrame:
    """Rows per category, country and month."""
    monthly = trending.withColumn("month", truncate_time(trending, "trending_date", "month"))
    per_video = monthly.groupBy("video_id", "country_dataset", "month").agg(F.count("*").alias("n"))
    return (
        per_video.join(videos.select("video_id", "category_name"), "video_id", "left")
        .groupBy("category_name", "country_dataset", "month")
        .agg(F.sum("n").alias("videos_in_category_per_month"))
    )


def catalogue_stats(shows: DataFrame, bridge: DataFrame, dimension: DataFrame, id_column: str, name: str) -> DataFrame:
    """Titles, total gross, mean rating and mean votes per entry of a dimension (genre, platform, ...).

    Rows are summed by id first; names join the sums.
    """
    measures = {
        "gross": F.col("cumulative_worldwide_gross_eur"),
        "rating": F.col("rating"),
        "votes": F.col("votes").try_cast("double"),
    }
    by_id = (
        bridge.select("show_id", id_column)
        .join(shows, "show_id")
        .groupBy(id_column)
        .agg(
            F.count("*").alias("n"),
            *[F.sum(m).alias(f"{key}_sum") for key, m in measures.items()],
            *[F.count(m).alias(f"{key}_n") for key, m in measures.items()],
        )
    )
    return _add_up(by_id.join(dimension, id_column), [name]).select(
        name,
        F.col("n").alias("count_of_shows_movies"),
        F.col("gross_sum").alias("total_gross_eur"),
        F.round(ratio("rating_sum", "rating_n"), 2).alias("average_rating"),
        F.round(ratio("votes_sum", "votes_n"), 2).alias("average_votes"),
    )


def catalogue_by_genre(shows: DataFrame, bridge: DataFrame, genres: DataFrame) -> DataFrame:
    return catalogue_stats(shows, bridge, genres, "genre_id", "genre_name")


def catalogue_by_platform(shows: DataFrame, bridge: DataFrame, platforms: DataFrame) -> DataFrame:
    return catalogue_stats(shows, bridge, platforms, "platform_id", "platform_name")


def catalogue_by_country(
    shows: DataFrame, bridge: DataFrame, countries: DataFrame, categories: dict[str, str] | None = None
) -> DataFrame:
    """Movies and shows per country as columns, and both together."""
    names = categories or {"Movie": "count_of_movies", "TV Show": "count_of_tv_shows"}
    counted = (
        bridge.select("show_id", "country_id")
        .join(shows.select("show_id", "category"), "show_id")
        .groupBy("country_id", "category")
        .agg(F.count("*").alias("n"))
    )
    named = counted.join(countries, "country_id")
    pivoted = named.groupBy("country_name").pivot("category", list(names)).agg(F.sum("n")).withColumnsRenamed(names)
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in names.values()]
    return pivoted.withColumn("count_of_both", sum(parts[1:], parts[0]))


def best_trailers(
    shows: DataFrame,
    videos: DataFrame,
    trending: DataFrame,
    candidate: Column | None = None,
    ties: str = "all",
    long_texts: bool = False,
) -> DataFrame:
    """The most viewed trailer of each title: videos whose title holds the title as whole words.

    ``shows`` has show_id, title, votes and gross; ``videos`` video_id, title and category_name;
    ``trending`` the daily figures, of which each video's maxima are taken one by one. Say
    ``long_texts`` when the video titles are too long to travel with each of their words.
    """
    titles = shows.select("show_id", F.col("title").alias("streaming_title"), "votes", "cumulative_worldwide_gross_eur")
    if candidate is None:
        candidate = trailer_condition(F.col("title"), F.col("category_name"))
    # A video's id and the hash of its title stand for the title, which may be long, until the best are known.
    trailers = videos.where(candidate).select("video_id", F.col("title").alias("video_title"), F.xxhash64("title").alias("__text"))
    pairs = match.matched_texts(titles, trailers, "streaming_title", "video_title", "video_id", inline_text=not long_texts)
    # Written once: the matches say which figures are needed, and are then joined with them.
    matched = durable(pairs.select("__title", "video_id", "__text"))
    measures = {c: c for c in ("view_count", "likes", "dislikes", "comment_count")}
    wanted = matched.select("video_id").distinct()
    peaks = stats.column_wise_max(trending.join(wanted, "video_id", "left_semi"), "video_id", measures)
    # Of each title first: the shows that share one have the same candidates.
    leading = match.best_per_key(durable(matched.join(peaks, "video_id")), "__title", "view_count")
    rated = durable(titles.join(leading, F.col("streaming_title") == F.col("__title")).drop("__title"))
    best = durable(match.best_per_key(rated, "show_id", "view_count", ties, ["video_id"]))
    found = trailers.join(best.select("video_id").distinct(), "video_id", "left_semi")
    named = best.join(durable(found.dropDuplicates(["video_id", "__text"])), ["video_id", "__text"])
    return named.select("show_id", "streaming_title", "video_id", "video_title", *measures, "votes", "cumulative_worldwide_gross_eur")


def tag_condensing_report(
    videos: DataFrame, rules: list[lookups.Rule] = lookups.TAG_RULES, top: int = 1000
) -> dict[str, DataFrame]:
    """How much of the tagging the most used condensed tags cover.

    Tables: ``tag_counts``, ``per_video``, ``coverage`` (one row), ``histogram`` and ``nulls``.
    """
    exploded = explode_array(videos.select("video_id", "tags"), "tags", "tag", lower=True).where("tag != ''")
    labelled = apply_per_distinct(exploded, "tag", "main_tag", lambda tag: last_match(tag, rules))
    # Written once: the counts and the flags both start from it.
    condensed = durable(labelled.select("video_id", "main_tag"))
    counts = stats.group_by_count(condensed, "main_tag")
    most_used = top_n(counts, [F.col("main_tag_count").desc(), F.col("main_tag").asc()], top)
    per_video = stats.flag_summary(flag_members(condensed, "main_tag", most_used, "top_x_tag"), "video_id", "top_x_tag")
    return {
        "tag_counts": counts,
        "per_video": per_video,
        "coverage": stats.tag_coverage(per_video, videos, "tags", "top_x_tag"),
        "histogram": stats.histogram(per_video, "tags_count"),
        "nulls": count_na(videos),
    }
