from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.operators.ranking import id_collisions
from reelsift.plans import cleaning, marts, stars
from reelsift.schemas import CATALOGUE_CLEANED, VIDEO_ENRICHED


def raw_trending(spark, *data):
    """Rows of (video, day, country, views, tags)."""
    df = spark.createDataFrame(list(data), "video_id string, day int, country_dataset string, view_count bigint, tags string")
    return df.select(
        "video_id",
        F.lit("T").alias("title"),
        F.lit("2024-01-01 12:00:00").cast("timestamp").alias("publishedAt"),
        F.lit("c1").alias("channelId"),
        F.lit("Channel").alias("channelTitle"),
        F.lit(10).alias("categoryId"),
        F.timestamp_seconds(F.col("day") * 86400 + 1704067200).alias("trending_date"),
        "tags",
        "view_count",
        F.lit(1).cast("bigint").alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
        F.lit(0).cast("bigint").alias("comment_count"),
        F.lit("link").alias("thumbnail_link"),
        F.lit(True).alias("comments_disabled"),
        F.lit(False).alias("ratings_disabled"),
        F.lit("Music").alias("category_name"),
        "country_dataset",
    )


RAW = [
    ("v1", 1, "US", 10, "a|B|a"), ("v1", 1, "US", 20, "a|B|a"), ("v1", 2, "US", 15, "[None]"), ("v1", 1, "BR", 5, None), ("v2", 1, "BR", None, "x"),
]


def test_trending_cleaning(spark):
    out = cleaning.trending_initial_cleaning(raw_trending(spark, *RAW))
    picked = rows(out.withColumn("d", F.dayofmonth("trending_date")), "video_id", "d", "country_dataset", "view_count", "comments_disabled")
    assert picked == [("v1", 2, "BR", 5, 1), ("v1", 2, "US", 20, 1), ("v1", 3, "US", 15, 1), ("v2", 2, "BR", None, 1)]
    lowest = cleaning.trending_initial_cleaning(raw_trending(spark, *RAW), keep_highest=False)
    assert 10 in [r.view_count for r in lowest.collect()]


def test_merged_videos(spark):
    out = cleaning.merged_videos(raw_trending(spark, *RAW))
    assert rows(out, "video_id", "view_count", "is_scraped", "tags") == [("v1", 15, 0, None), ("v2", None, 0, ["x"])]
    named = {f.split(" ", 1)[0] for f in VIDEO_ENRICHED.replace("map<string, ", "map<string,").split(", ")}
    assert set(out.columns) == named


def test_silver_videos(spark):
    enriched = cleaning.merged_videos(raw_trending(spark, *RAW)).withColumns(
        {"duration": F.lit("PT4M13S"), "caption": F.lit("True"), "licensed_content": F.lit(True)}
    )
    out = cleaning.silver_videos(raw_trending(spark, *RAW), enriched)
    assert rows(out, "video_id", "duration", "caption", "licensed_content", "comments_disabled") == [
        ("v1", "0.00:04:13", 1, 1, 1), ("v2", "0.00:04:13", 1, 1, 1),
    ]


def test_raw_catalogue(spark):
    columns = "show_id string, category string, age_required string, title string, director string, cast string, countries string, date_added string, release_year int, duration string, genres string, platform string"
    base = ("D", "A, B", ", France", "September 9, 2019", 2019)
    df = spark.createDataFrame(
        [
            ("nflx1", "Movie", "74 min", "Louis", *base, None, "Dramas", "Netflix"),
            ("nflx2", "Movie", "TV-MA", "Louis", *base, "90 min", "Dramas", "Netflix"),
            ("nflx8795", "Movie", "NR", "اشتباك", *base, "90 min", "Anime Series", "Netflix"),
            ("amzn1", "Movie", "?", "30 Minutes of Yoga", *base, "90 min", None, "Amazon"),
            ("amzn2", "Movie", "18+", None, *base, "90 min", None, "Amazon"),
        ],
        columns,
    )
    out = cleaning.clean_raw_catalogue(df)
    assert rows(out, "show_id", "title", "age_required", "duration", "countries", "is_animation", "is_scraped") == [
        ("nflx1", "Louis", None, "74 min", "France", "no", "No"),
        ("nflx8795", "Clash", None, "90 min", "France", "yes", "No"),
    ]
    assert out.columns == cleaning.CATALOGUE_COLUMNS
    assert {r.date_added for r in out.collect()} == {date(2019, 9, 9)}


def test_enriched_catalogue_has_the_declared_columns(spark):
    from reelsift.schemas import CATALOGUE_ENRICHED

    df = spark.createDataFrame([], CATALOGUE_ENRICHED)
    blank = spark.range(3).select(
        *[
            F.lit({"title": "T", "platform": "P", "category": "Movie", "duration": "90 min", "rating": "7.123"}.get(f.name)).cast(f.dataType).alias(f.name)
            if f.name != "show_id" else F.concat(F.lit("s"), F.col("id").cast("string")).alias("show_id")
            for f in df.schema.fields
        ]
    )
    out = cleaning.clean_enriched_catalogue(blank, run_date="2024-01-02")
    expected = spark.createDataFrame([], CATALOGUE_CLEANED)
    assert {(f.name, f.dataType.simpleString()) for f in out.schema.fields} == {(f.name, f.dataType.simpleString()) for f in expected.schema.fields}
    assert rows(out, "show_id", "duration_minutes", "rating", "last_updated_date") == [("s0", 90, 7.12, date(2024, 1, 2))]


def test_budget_floor(spark):
    texts = [("s1", "{Budget=EUR9 (estimated)}"), ("s2", "{Budget=EUR10 (estimated)}"), ("s3", None)]
    df = spark.createDataFrame([(s, s, "P", b, "x", None, None) for s, b in texts], "show_id string, title string, platform string, box_office string, genres string, release_date string, rating string")
    out = cleaning.clean_enriched_catalogue(df.withColumn("last_updated_date", F.current_date()))
    assert rows(out, "show_id", "budget_eur") == [("s2", 10.0), ("s3", None)]


@pytest.fixture
def tagged(spark):
    videos = spark.createDataFrame([("v1", ["Funny", "Spiel", "funny"]), ("v2", ["spiel", "zzz"]), ("v3", None)], "video_id string, tags array<string>")
    translations = spark.createDataFrame([("funny", "funny"), ("spiel", "gaming video")], "original_tag string, translated_tag string")
    return videos, translations


@pytest.mark.parametrize("ids", ["dense", "hash"])
def test_tag_star(spark, tagged, ids):
    bridge, tags = stars.tag_star(*tagged, ids=ids)
    assert rows(bridge.join(tags, "tag_id"), "video_id", "tag") == [("v1", "comedy"), ("v1", "gaming"), ("v2", "[OTHERS]"), ("v2", "gaming")]
    assert bridge.join(tags, "tag_id", "left_anti").count() == 0 and id_collisions(tags, "tag_id").count() == 0


def test_catalogue_entities_resolve(spark):
    df = spark.createDataFrame(
        [("s1", "A, B", "Drama", "Netflix"), ("s2", " B", "Drama", "Amazon"), ("s3", None, None, "Netflix")],
        "show_id string, cast string, genres string, platform string",
    )
    full = spark.createDataFrame([], CATALOGUE_CLEANED).unionByName(df, allowMissingColumns=True)
    tables = stars.catalogue_entities(full)
    assert len(tables) == 17
    for entity, (_, name, key) in stars.CATALOGUE_ENTITIES.items():
        assert tables[f"shows_and_movies_{entity}"].join(tables[entity], key, "left_anti").count() == 0
    actors = tables["shows_and_movies_actors"].join(tables["actors"], "actor_id")
    assert rows(actors, "show_id", "actor_name") == [("s1", "A"), ("s1", "B"), ("s2", "B")]


@pytest.mark.parametrize("ids", ["dense", "hash"])
def test_music_entities(spark, ids):
    genres = spark.createDataFrame([(1, "trap metal"), (2, "death metal"), (3, "polka")], "id_genre bigint, name_genre string")
    artists = spark.createDataFrame([("a1", "A", "RO", "1990", "solo"), ("a2", "B", None, None, None)], "id_artist string, name_artist string, country string, birth_date string, type string")
    pairs = spark.createDataFrame([("a1", 1), ("a1", 2), ("a2", 2), ("gone", 3)], "id_artist string, id_genre bigint")
    tracks = spark.range(0).select(*[F.lit("x").alias(c) for c in {c for t in ("tracks", "tracks_stats", "tracks_artists") for c in stars.MUSIC_PROJECTIONS[t]}])
    out = stars.music_entities(
        {"genres": genres, "artists": artists, "artists_genres": pairs, "tracks": tracks, "tracks_stats": tracks, "tracks_artists": tracks}, ids=ids
    )
    assert rows(out["artists_genre"].join(out["genres"], "id_genre"), "id_artist", "name_genre") == [("a1", "metal"), ("a2", "metal")]
    assert rows(out["genres"], "name_genre") == [("metal",)]
    assert set(out) == {"tracks", "tracks_stats", "tracks_artists", "artists", "artists_genre", "genres"}


def trending(spark, *data):
    df = spark.createDataFrame(list(data), "video_id string, day int, country_dataset string, view_count bigint, likes bigint")
    return df.withColumn("trending_date", F.timestamp_seconds(F.col("day") * 86400 + 1704067200)).drop("day")


def test_every_tag_of_a_video_counts_once(spark):
    facts = trending(spark, ("v1", 1, "US", 2_000_000, 10), ("v1", 2, "US", 9_000_000, 90), ("v2", 1, "US", 1_000_000, 1), ("v3", 1, "US", 1_000_001, None))
    bridge = spark.createDataFrame([("v1", 1), ("v1", 2), ("v1", 3), ("v2", 1), ("v3", 1)], "video_id string, tag_id bigint")
    tags = spark.createDataFrame([(1, "a"), (2, "b"), (3, "[OTHERS]"), (4, None)], "tag_id bigint, tag string")
    out = marts.tag_statistics(facts, bridge, tags, min_videos=0)
    assert rows(out) == [("a", 2, 1500000.5, 10.0, 5e-06), ("b", 1, 2000000.0, 10.0, 5e-06)]
    assert rows(marts.tag_statistics(facts, bridge, tags, min_videos=0, exclude="b"), "tag") == [("[OTHERS]",), ("a",)]


def test_top_tags(spark):
    facts = trending(spark, ("v1", 1, "US", 2_000_000, 10), ("v1", 2, "US", 4_000_000, 10), ("v2", 1, "US", 2_000_000, 10), ("v2", 1, "BR", 0, 10))
    bridge = spark.createDataFrame([("v1", 1), ("v1", 2), ("v2", 3)], "video_id string, tag_id bigint")
    tags = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "tag_id bigint, tag string")
    out = marts.top_tags_per_country(facts, bridge, tags, k=2)
    assert rows(out, "tag", "videos_count", "avg_view_count", "tag_country_rank") == [("a", 2, 3e6, 1), ("b", 2, 3e6, 2)]
    videos = marts.top_tags_per_country(facts, bridge, tags, k=3, count_videos=True)
    assert rows(videos, "tag", "videos_count") == [("a", 1), ("b", 1), ("c", 1)]
    assert "WindowGroupLimit" in plan(out) and "SinglePartition" not in plan(out)


def test_category_shares_sum_to_one(spark):
    facts = trending(spark, ("v1", 1, "US", 1, 1), ("v1", 2, "US", 1, 1), ("v2", 1, "US", 1, 1), ("v2", 1, "BR", 1, 1), ("v9", 1, "BR", 1, 1))
    videos = spark.createDataFrame([("v1", "Music"), ("v2", "News")], "video_id string, category_name string")
    out = marts.category_distribution(facts, videos)
    assert rows(out, "country_dataset", "category_name", "videos_in_category_per_country") == [
        ("ALL", "Music", 2), ("ALL", "News", 2), ("ALL", None, 1), ("BR", "News", 1), ("BR", None, 1), ("US", "Music", 2), ("US", "News", 1),
    ]
    sums = out.groupBy("country_dataset").agg(F.round(F.sum("percent_of_country_trending_videos"), 9).alias("s"))
    assert {r.s for r in sums.collect()} == {1.0}
    monthly = marts.monthly_category_distribution(facts, videos)
    assert rows(monthly, "country_dataset", "category_name", "videos_in_category_per_month")[0] == ("BR", "News", 1)
    assert {r.month for r in monthly.collect()} == {datetime(2024, 1, 1)}


def test_catalogue_marts(spark):
    shows = spark.createDataFrame(
        [("s1", "Movie", 10.0, 7.0, "4"), ("s2", "TV Show", None, 8.0, None), ("s3", "Movie", 5.0, None, "2")],
        "show_id string, category string, cumulative_worldwide_gross_eur double, rating double, votes string",
    )
    bridge = spark.createDataFrame([("s1", 1), ("s2", 1), ("s3", 2), ("s1", 2)], "show_id string, country_id bigint")
    countries = spark.createDataFrame([(1, "US"), (2, "BR")], "country_id bigint, country_name string")
    assert rows(marts.catalogue_by_country(shows, bridge, countries)) == [("BR", 2, None, 2), ("US", 1, 1, 2)]
    genres = countries.toDF("genre_id", "genre_name")
    out = marts.catalogue_by_genre(shows, bridge.toDF("show_id", "genre_id"), genres)
    assert rows(out) == [("BR", 2, 15.0, 7.0, 3.0), ("US", 2, 10.0, 7.5, 4.0)]


def test_best_trailers(spark):
    shows = spark.createDataFrame([("s1", "The Office", "1", 1.0), ("s2", "Short", "1", 1.0), ("s3", "Mamma Mia", "1", 1.0)], "show_id string, title string, votes string, cumulative_worldwide_gross_eur double")
    videos = spark.createDataFrame(
        [("v1", "the office trailer", "Film"), ("v2", "THE OFFICE official Trailer", "Film"), ("v3", "The Office trailer reaction", "Film"),
         ("v4", "theofficetrailer", "Film"), ("v5", "Short trailer", "Film"), ("v6", "Mamma Mia trailer", "Film"), ("v7", "the office trailer", "Gaming")],
        "video_id string, title string, category_name string",
    )
    facts = spark.createDataFrame(
        [("v1", 5, 1, 1, 1), ("v1", 9, 0, 1, 1), ("v2", 9, 3, 1, 1), ("v3", 99, 1, 1, 1), ("v6", None, 1, 1, 1)],
        "video_id string, view_count bigint, likes bigint, dislikes bigint, comment_count bigint",
    )
    out = marts.best_trailers(shows, videos, facts)
    assert rows(out, "show_id", "video_id", "view_count", "likes") == [("s1", "v1", 9, 1), ("s1", "v2", 9, 3)]
    assert rows(marts.best_trailers(shows, videos, facts, ties="one"), "video_id") == [("v1",)]


def test_best_trailers_are_found_without_the_texts_of_all_matches(spark, monkeypatch):
    shows = spark.range(40).select(F.concat(F.lit("s"), "id").alias("show_id"), F.lit("The Office").alias("title"), F.lit("1").alias("votes"), F.lit(1.0).alias("cumulative_worldwide_gross_eur"))
    videos = spark.range(30).select(F.concat(F.lit("v"), "id").alias("video_id"), F.concat(F.lit("The Office trailer "), "id").alias("title"), F.lit("Film").alias("category_name"))
    videos = videos.unionByName(videos.where("video_id = 'v29'").withColumn("title", F.lit("Another trailer")))
    facts = spark.range(30).select(F.concat(F.lit("v"), "id").alias("video_id"), *[F.col("id").alias(c) for c in ("view_count", "likes", "dislikes", "comment_count")])
    written = []

    def count(df):
        written.append((df.count(), df.columns))
        return df.localCheckpoint()

    monkeypatch.setattr(marts, "durable", count)
    for long_texts in (True, False):
        out = marts.best_trailers(shows, videos, facts, long_texts=long_texts)
        # All 30 videos match all 40 shows; the view counts leave one, which is all that gets its text.
        assert set(rows(out, "video_id", "video_title", "view_count")) == {("v29", "The Office trailer 29", 29)} and out.count() >= 40
    assert max(n for n, _ in written) <= 80 and max(n for n, columns in written if "video_title" in columns) <= 2


def test_tag_report(spark):
    videos = spark.createDataFrame([("v1", ["Gaming", "x", "gamer"]), ("v2", ["x", ""]), ("v3", None), ("v4", ["rare"])], "video_id string, tags array<string>")
    report = marts.tag_condensing_report(videos, top=2)
    assert rows(report["tag_counts"]) == [("gaming", 2), ("rare", 1), ("x", 2)]
    assert rows(report["per_video"]) == [("v1", 3, 3, 1), ("v2", 1, 1, 1), ("v4", 1, 0, 0)]
    assert rows(report["coverage"]) == [(4, 1.25, 0.75, 1.0, 0.5)]
    assert rows(report["histogram"]) == [(1, 2), (3, 1)]
    assert rows(report["nulls"]) == [(0, 1)]
