"""Raw rows through every layer, with the tables written and read between them."""

import json
import uuid

from pyspark.sql import functions as F

from conftest import rows
from reelsift import schemas
from reelsift.functions import landed
from reelsift.operators import enrich
from reelsift.plans import cleaning, marts, stars
from reelsift.sources import readers, writers


def test_catalogue(spark, tmp_path):
    database, base = f"db_{uuid.uuid4().hex}", str(tmp_path / "lake")
    writers.create_database(spark, database, str(tmp_path / "db"))
    raw = spark.createDataFrame(
        [
            ("nflx1", "Movie", "PG-13", "The Office", "D", "A, B", "US", "September 9, 2019", 2019, "90 min", "Dramas, Comedies", "Netflix", "2024-01-01"),
            ("nflx2", "TV Show", "74 min", "Clash", None, None, ", France", None, 2018, None, "Anime Series", "Netflix", "2024-01-01"),
            ("dsny1", "TV Show", "TV-G", "Later", None, None, "US", None, 2018, "2 Seasons", "Kids", "Disney", "2024-02-01"),
        ],
        "show_id string, category string, age_required string, title string, director string, cast string, countries string, date_added string, "
        "release_year int, duration string, genres string, platform string, last_updated_date string",
    )
    writers.create_table(spark, database, "bronze", schemas.CATALOGUE_BRONZE)
    for day in ("2024-01-01", "2024-02-01"):
        writers.expose_view(cleaning.clean_raw_catalogue(raw, file_date=day), "cleaned_view")
        writers.merge_tables(spark, database, "bronze", "cleaned_view", run_date=day, base_path=base)
    bronze = spark.table(f"{database}.bronze").withColumnRenamed("release_year", "release_date")
    assert bronze.count() == 3

    hits = spark.createDataFrame([("the office", 1, "tt1"), ("clash", 1, "tt2")], "title string, position int, imdb_id string")
    with_ids = enrich.lookup_ids(bronze, hits).withColumn("release_date", F.col("release_date").cast("string"))
    answer = {"rating": 8.126, "votes": 100, "genres": [], "languages": ["English"], "color": ["Color"], "countries": ["US", "UK"],
              "box office": "{Budget=$40,000,000 (estimated), Cumulative Worldwide Gross=$100}", "original air date": "15 Jun 2012 (USA)"}
    answers = landed.title_columns(spark.createDataFrame([("tt1", json.dumps(answer))], "imdb_id string, response string"))
    enriched = enrich.enrich_titles(with_ids, answers)
    cleaned = cleaning.clean_enriched_catalogue(enriched, run_date="2024-03-01")
    picked = rows(cleaned, "show_id", "duration_minutes", "duration_seasons", "genres", "rating", "budget_eur", "is_scraped")
    assert picked == [
        ("dsny1", None, 2, "Kids", None, None, "Yes"), ("nflx1", 90, None, "Comedy", 8.13, 36094568.0, "Yes"), ("nflx2", None, 74, "Anime", None, None, "Yes"),
    ]

    tables = stars.catalogue_entities(cleaned)
    writers.save_tables(tables, database)
    table = lambda name: readers.read_table(spark, database, name)
    by_country = marts.catalogue_by_country(table("shows_and_movies"), table("shows_and_movies_countries"), table("countries"))
    assert rows(by_country) == [("France", None, 1, 1), ("UK", 1, None, 1), ("US", 1, 1, 2)]
    by_genre = marts.catalogue_by_genre(table("shows_and_movies"), table("shows_and_movies_genres"), table("genres"))
    assert rows(by_genre)[1] == ("Comedy", 1, 90.0, 8.13, 100.0)
    by_platform = marts.catalogue_by_platform(table("shows_and_movies"), table("shows_and_movies_platforms"), table("platforms"))
    assert rows(by_platform, "platform_name", "count_of_shows_movies") == [("Disney", 1), ("Netflix", 2)]


def test_trending(spark, tmp_path):
    columns = "video_id,title,publishedAt,channelId,channelTitle,categoryId,trending_date,tags,view_count,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,description"
    line = '{},"The Office, trailer",2024-01-01T12:00:00Z,c1,Channel,10,2024-01-{}T00:00:00Z,funny|news,{},10,1,2,link,True,False,"two\nlines"'
    files = {"US": [("v1", "02", 5), ("v1", "03", 2_000_000), ("v2", "03", 3_000_000)], "BR": [("v1", "02", 7)]}
    raw_folder = tmp_path / "raw"
    raw_folder.mkdir()
    for country, data in files.items():
        (raw_folder / f"{country}_trending_data.csv").write_text("\n".join([columns, *[line.format(*r) for r in data]]) + "\n")
    ddl = schemas.RAW_TRENDING.rsplit(", category_name", 1)[0] + ", description string"
    category = tmp_path / "US_category_id.json"
    category.write_text('{"items": [{"id": "10", "snippet": {"title": "Comedy"}}]}')
    raw = readers.add_category_name(
        readers.read_country_files(spark, str(raw_folder), ddl), readers.read_category_lookup(spark, str(category))
    )
    videos = cleaning.merged_videos(raw)
    response = {"id": "v1", "snippet": {"tags": ["Funny", "News", "odd"]}, "contentDetails": {"duration": "PT2M", "caption": "true", "licensedContent": True, "regionRestriction": {"blocked": ["US"]}}}
    answers = landed.video_columns(spark.createDataFrame([(json.dumps(response),)], "response string"))
    enriched = enrich.enrich_videos(videos, answers)
    assert rows(enriched, "video_id", "is_scraped", "view_count") == [("v1", 1, 2_000_000), ("v2", -1, 3_000_000)]

    silver = cleaning.silver_videos(raw, enriched)
    assert rows(stars.region_restrictions(silver)) == [("v1", "blocked", "US")]
    assert rows(stars.channel_dimension(silver)) == [("c1", "Channel")]
    translations = spark.createDataFrame([("funny", "funny"), ("news", "news")], "original_tag string, translated_tag string")
    bridge, tags = stars.tag_star(silver, translations)
    assert rows(marts.video_tags(bridge, tags)) == [("v1", "[OTHERS]"), ("v1", "comedy"), ("v1", "news"), ("v2", "comedy"), ("v2", "news")]

    facts = cleaning.trending_initial_cleaning(raw)
    top = marts.top_tags_per_country(facts, bridge, tags)
    assert rows(top, "tag", "country_dataset", "videos_count", "tag_country_rank") == [("comedy", "US", 2, 1), ("news", "US", 2, 2)]
    detailed = marts.trending_with_details(facts, silver, stars.channel_dimension(silver))
    assert detailed.columns == marts.TRENDING_COLUMNS and detailed.count() == 4
    assert {str(r.local_publish_date) for r in detailed.where("country_dataset = 'US'").collect()} == {"2024-01-01 07:00:00"}
    shares = marts.category_distribution(facts, silver)
    assert rows(shares, "country_dataset", "category_name", "videos_in_category_per_country") == [("ALL", "Comedy", 4), ("BR", "Comedy", 1), ("US", "Comedy", 3)]

    shows = spark.createDataFrame([("s1", "the office", "1", 1.0)], "show_id string, title string, votes string, cumulative_worldwide_gross_eur double")
    best = marts.best_trailers(shows, silver, facts)
    assert rows(best, "show_id", "video_id", "view_count") == [("s1", "v2", 3_000_000)]
