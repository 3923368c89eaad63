"""Landed JSON responses (one text per requested id) to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.values import (
    is_colour,
    is_present,
    list_to_comma_separated_string,
    mode_name,
    names_text,
    percent_to_unit,
    pitch_name,
)

VIDEO_RESPONSE = """
    id string,
    snippet struct<tags: array<string>, defaultLanguage: string>,
    contentDetails struct<duration: string, caption: string, licensedContent: boolean,
        regionRestriction: map<string, array<string>>, contentRating: map<string, string>>
"""
TRACK_RESPONSE = """
    id string, name string, artists array<struct<name: string, id: string>>,
    album struct<name: string, id: string>, external_ids struct<isrc: string>,
    explicit boolean, popularity double
"""
ARTIST_RESPONSE = "id string, name string, genres array<string>, popularity double, followers struct<total: bigint>"
ALBUM_RESPONSE = """
    id string, name string, album_type string, release_date string, label string,
    popularity double, total_tracks int
"""
AUDIO_FEATURES = ["danceability", "energy", "speechiness", "acousticness", "instrumentalness", "liveness"]
AUDIO_RESPONSE = (
    "id string, `key` int, mode int, tempo double, valence string, "
    + ", ".join(f"{name} string" for name in AUDIO_FEATURES)
)
TITLE_RESPONSE = """
    countries array<string>, rating string, votes string, languages array<string>, color array<string>,
    `top 250 rank` string, `box office` string, `cast` array<struct<name: string>>,
    director array<struct<name: string>>, `production companies` array<struct<name: string>>,
    writers array<struct<name: string>>, `series years` string, `original air date` string
"""
SEARCH_RESPONSE = "array<struct<movieID: string, title: string>>"


def _flatten(df: DataFrame, body: str, schema: str, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    parsed = df.withColumn("__r", F.from_json(F.col(body), schema))
    return parsed.select(*keep, *[column.alias(name) for name, column in columns.items()])


def _field(path: str) -> Column:
    return F.col(f"__r.{path}")


def video_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    """Video details; fields that a response leaves out become null."""
    columns = {
        "video_id": _field("id"),
        "tags": _field("snippet.tags"),
        "default_language": _field("snippet.defaultLanguage"),
        "duration": _field("contentDetails.duration"),
        "caption": _field("contentDetails.caption"),
        "licensed_content": _field("contentDetails.licensedContent"),
        "region_restriction": _field("contentDetails.regionRestriction"),
        "content_rating": _field("contentDetails.contentRating"),
    }
    return _flatten(df, body, VIDEO_RESPONSE, columns, list(keep))


def track_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    columns = {
        "name_track": _field("name"),
        "name_artist_list": names_text("__r.artists"),
        "id_artist_list": names_text("__r.artists", "id"),
        "name_album": _field("album.name"),
        "isrc": _field("external_ids.isrc"),
        "id_track": _field("id"),
        "is_explicit": _field("explicit").cast("int"),
        "popularity_track": percent_to_unit("__r.popularity"),
        "id_album": _field("album.id"),
    }
    return _flatten(df, body, TRACK_RESPONSE, columns, list(keep))


def artist_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    columns = {
        "name_artist": _field("name"),
        "genres": _field("genres"),
        "popularity_artist": percent_to_unit("__r.popularity"),
        "id_artist": _field("id"),
        "followers": _field("followers.total"),
    }
    return _flatten(df, body, ARTIST_RESPONSE, columns, list(keep))


def album_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    columns = {
        "id_album": _field("id"),
        "name_album": _field("name"),
        "album_type": _field("album_type"),
        "release_date": _field("release_date"),
        "label": _field("label"),
        "popularity_album": percent_to_unit("__r.popularity"),
        "no_of_tracks": _field("total_tracks"),
    }
    return _flatten(df, body, ALBUM_RESPONSE, columns, list(keep))


def audio_feature_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    """Audio features with pitch and mode decoded; the measures stay text, as they were answered."""
    columns = {
        "id_track": _field("id"),
        "key": pitch_name("__r.key"),
        "mode": mode_name("__r.mode"),
        **{name: _field(name) for name in AUDIO_FEATURES},
        "bpm": _field("tempo").cast("bigint").cast("string"),
        "valence": _field("valence"),
    }
    return _flatten(df, body, AUDIO_RESPONSE, columns, list(keep))


def title_columns(df: DataFrame, body: str = "response", keep: tuple[str, ...] = ("imdb_id",)) -> DataFrame:
    """Title details of a film database, lists joined to text."""
    columns = {
        "countries": list_to_comma_separated_string("__r.countries"),
        "rating": _field("rating").try_cast("double"),
        "votes": _field("votes").try_cast("bigint"),
        "languages": list_to_comma_separated_string("__r.languages"),
        "color": is_colour("__r.color"),
        "top_250": is_present("__r.`top 250 rank`"),
        "box_office": _field("`box office`"),
        "cast": names_text("__r.cast"),
        "director": names_text("__r.director"),
        "production_companies": names_text("__r.`production companies`"),
        "writers": names_text("__r.writers"),
        "series_years": _field("`series years`"),
        "release_date": _field("`original air date`"),
    }
    return _flatten(df, body, TITLE_RESPONSE, columns, list(keep))


def top_search_hit(body: str | Column) -> Column:
    """Id of the first hit in a search answer, null when there is none."""
    hits = F.from_json(F.col(body) if isinstance(body, str) else body, SEARCH_RESPONSE)
    return F.get(hits, F.lit(0))["movieID"]
