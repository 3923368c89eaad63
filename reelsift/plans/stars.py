"""Dimensional models: video tags, channels, regions, catalogue entities, music genres."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift import lookups
from reelsift.functions.rules import last_match, map_genre
from reelsift.operators.dedup import drop_duplicates_by_ordered_partition
from reelsift.operators.dims import create_association_table, create_unique_df
from reelsift.operators.ranking import dense_ids, hashed_id
from reelsift.operators.reshape import explode_array, explode_map_of_lists
from reelsift.session import durable


def tag_star(
    videos: DataFrame,
    translations: DataFrame,
    rules: list[lookups.Rule] = lookups.TAG_RULES,
    placeholder: str = lookups.OTHER_TAG,
    ids: str = "dense",
) -> tuple[DataFrame, DataFrame]:
    """(video_id, tag_id) bridge and (tag_id, tag) dimension of the condensed tags.

    Tags are lower-cased, translated (no translation gives the placeholder) and condensed by the
    rules; a condensed tag's id is its rank among all of them, or with ``ids="hash"`` a hash of it.
    Rules run once per distinct translated tag; their outcome is written before it is joined.
    """
    keyed = translations.select(F.col("original_tag").alias("tag"), "translated_tag")
    raw = explode_array(videos.select("video_id", "tags"), "tags", "tag", lower=True).distinct()
    # Written once: the distinct tags and the bridge both start from it.
    translated = durable(
        raw.join(keyed, "tag", "left")
        .select("video_id", F.coalesce("translated_tag", F.lit(placeholder)).alias("tag"))
        .distinct()
    )
    condensed = durable(translated.select("tag").distinct().withColumn("main_tag", last_match("tag", rules)))
    if ids == "hash":
        labelled = condensed.withColumn("tag_id", hashed_id(F.col("main_tag")))
        dimension = labelled.select("tag_id", F.col("main_tag").alias("tag")).distinct()
    else:
        numbered = dense_ids(condensed, "main_tag", "tag_id")
        labelled = condensed.join(numbered, "main_tag")
        dimension = numbered.select("tag_id", F.col("main_tag").alias("tag"))
    bridge = translated.join(labelled, "tag").select("video_id", "tag_id").distinct()
    return bridge, dimension


def channel_dimension(videos: DataFrame) -> DataFrame:
    """One title per channel: the least one."""
    return drop_duplicates_by_ordered_partition(
        videos.select("channel_id", "channel_title"), "channel_id", "channel_title"
    )


def region_restrictions(videos: DataFrame) -> DataFrame:
    """Distinct (video, restriction type, country) rows."""
    return explode_map_of_lists(videos, "region_restriction", "restriction_type", "country_code", ["video_id"])


# Entity -> (list column, name column, id column).
CATALOGUE_ENTITIES = {
    "directors": ("director", "director_name", "director_id"),
    "actors": ("cast", "actor_name", "actor_id"),
    "countries": ("countries", "country_name", "country_id"),
    "genres": ("genres", "genre_name", "genre_id"),
    "prod_companies": ("production_companies", "prod_company_name", "prod_company_id"),
    "writers": ("writers", "writer_name", "writer_id"),
    "languages": ("languages", "language_name", "language_id"),
    "platforms": ("platform", "platform_name", "platform_id"),
}
SHOW_COLUMNS = [
    "show_id", "category", "age_required", "title", "date_added", "release_date", "rating", "votes",
    "color", "top_250", "is_animation", "imdb_id", "duration_minutes", "duration_seasons",
    "first_series_years", "last_series_years", "budget_eur", "opening_weekend_eur",
    "cumulative_worldwide_gross_eur",
]


def catalogue_entities(cleaned: DataFrame, trim: bool = True) -> dict[str, DataFrame]:
    """Eight dimensions, their bridges ``shows_and_movies_<entity>`` and the fact table ``shows_and_movies``.

    Ids are hashes of the names, so bridges need no join and all tables agree however often they are
    computed.
    """
    tables = {"shows_and_movies": cleaned.select(*SHOW_COLUMNS)}
    for entity, (column, name, id_name) in CATALOGUE_ENTITIES.items():
        tables[entity] = create_unique_df(cleaned, column, name, id_name, trim=trim)
        tables[f"shows_and_movies_{entity}"] = create_association_table(
            cleaned, None, column, name, "show_id", id_name, trim=trim
        )
    return tables


# Fixed projections of the music tables.
MUSIC_PROJECTIONS = {
    "tracks_stats": ["id_track", "streams", "playlist_count", "popularity_track", "source_dataset"],
    "tracks": [
        "id_track", "name_track", "isrc", "bpm", "key", "mode", "release_date", "danceability", "energy",
        "acousticness", "instrumentalness", "liveness", "speechiness",
    ],
    "tracks_artists": ["id_track", "id_artist", "is_main_artist"],
    "artists": ["id_artist", "name_artist", "country", "birth_date", "type"],
}


def genre_star(
    genres: DataFrame,
    artists: DataFrame,
    artists_genres: DataFrame,
    rules: list[lookups.Rule] = lookups.MUSIC_GENRE_RULES,
    ids: str = "hash",
) -> tuple[DataFrame, DataFrame]:
    """(id_artist, id_genre) bridge and (id_genre, name_genre) dimension of the general genres.

    Only artists with a row in ``artists`` and general genres that one of them has are kept.
    """
    mapped = genres.select("id_genre", map_genre("name_genre", rules).alias("mapped_genre"))
    if ids == "dense":
        general = dense_ids(mapped, "mapped_genre", "id_general_genre")
        mapped = mapped.join(general, "mapped_genre")
    else:
        mapped = mapped.withColumn("id_general_genre", hashed_id(F.col("mapped_genre")))
    pairs = (
        artists_genres.join(mapped, "id_genre")
        .select("id_artist", "id_general_genre", "mapped_genre")
        .distinct()
        .join(artists.select("id_artist"), "id_artist", "left_semi")
    )
    bridge = pairs.select("id_artist", F.col("id_general_genre").alias("id_genre")).distinct()
    dimension = pairs.select(
        F.col("id_general_genre").alias("id_genre"), F.col("mapped_genre").alias("name_genre")
    ).distinct()
    return bridge, dimension


def music_entities(tables: dict[str, DataFrame], ids: str = "hash") -> dict[str, DataFrame]:
    """The six music tables out of the raw ones."""
    out = {name: tables[name].select(*columns) for name, columns in MUSIC_PROJECTIONS.items()}
    out["artists_genre"], out["genres"] = genre_star(
        tables["genres"], tables["artists"], tables["artists_genres"], ids=ids
    )
    return out
