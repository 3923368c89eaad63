"""Enrichment from tables of landed responses: pending rows, merges by precedence, id lookup."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsift.operators.dedup import drop_duplicates_by_ordered_partition, total_order
from reelsift.operators.reshape import add_not_found_rows
from reelsift.operators.schema import ensure_column_existence
from reelsift.session import durable

NEW_FIRST = "new_first"
NEW_ONLY = "new_only"
OLD_FIRST = "old_first"

# How many ids one request holds.
REQUEST_SIZES = {"video": 50, "audio_features": 100, "album": 20, "artist": 50}


def pending_rows(df: DataFrame, columns: list[str] | None = None, flag: str | None = None, value=0) -> DataFrame:
    """Rows still to be enriched: the flag has the pending value, or one of the columns is null; all rows if neither is given."""
    conditions = [F.col(c).isNull() for c in columns or []]
    if flag:
        conditions.append(F.col(flag) == F.lit(value))
    return df.where(reduce(or_, conditions)) if conditions else df


def _one_answer(answers: DataFrame, key: str, order_by: list | None) -> DataFrame:
    order = order_by or total_order(answers)
    return drop_duplicates_by_ordered_partition(answers.where(F.col(key).isNotNull()), key, order)


def merge_answers(
    df: DataFrame,
    answers: DataFrame,
    key: str,
    policy: dict[str, str],
    order_by: list | None = None,
    unique_answers: bool = False,
) -> DataFrame:
    """Merge the answers for a key into the table with one join.

    ``policy`` says per column whether the new value wins when there is one (``new_first``), replaces
    the old one in any case (``new_only``), or only fills a null (``old_first``). Columns that the
    table lacks are added. Of several answers for a key one is taken, unless ``unique_answers`` says
    that there is only one.
    """
    out = df
    for column in policy:
        out = ensure_column_existence(out, column, answers.schema[column].dataType)
    single = answers if unique_answers else _one_answer(answers, key, order_by)
    prefixed = single.select(F.col(key).alias(key), *[F.col(c).alias(f"__new_{c}") for c in policy])
    merged = {
        NEW_FIRST: lambda c: F.coalesce(f"__new_{c}", c),
        NEW_ONLY: lambda c: F.col(f"__new_{c}"),
        OLD_FIRST: lambda c: F.coalesce(c, f"__new_{c}"),
    }
    order = out.columns
    joined = out.join(prefixed, key, "left")
    return joined.withColumns({c: merged[rule](c) for c, rule in policy.items()}).select(*order)


def enrich_videos(videos: DataFrame, answers: DataFrame, key: str = "video_id", flag: str = "is_scraped") -> DataFrame:
    """Fill the details of pending videos: flag 1 where answered, -1 where asked for without an answer."""
    videos = ensure_column_existence(videos, flag, "int", 0)
    asked = pending_rows(videos, flag=flag, value=0).select(key)
    answered = answers.withColumn(flag, F.lit(1)).join(asked, key, "left_semi")
    # Written once: the missing ones are told from the answers, and both are merged.
    every_asked = add_not_found_rows(durable(_one_answer(answered, key, None)), asked, key, flag)
    policy = {c: NEW_FIRST for c in every_asked.columns if c != key}
    return merge_answers(videos, every_asked, key, policy, unique_answers=True)


def fill_missing_data(df: DataFrame, answers: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Overwrite the columns by the answers given for rows that lack any of them.

    As answers are per key, rows that share a key with an incomplete row take the answer too.
    """
    out = df
    for column in columns:
        out = ensure_column_existence(out, column, answers.schema[column].dataType)
    asked = pending_rows(out, columns).select(key)
    relevant = answers.join(asked, key, "left_semi")
    return merge_answers(out, relevant, key, {c: NEW_FIRST for c in columns})


TITLE_POLICY = {
    **{c: NEW_FIRST for c in ["director", "cast", "countries", "release_date"]},
    **{
        c: NEW_ONLY
        for c in [
            "rating", "votes", "languages", "color", "top_250", "box_office",
            "production_companies", "writers", "series_years",
        ]
    },
}


def enrich_titles(titles: DataFrame, answers: DataFrame, key: str = "imdb_id", flag: str = "is_scraped") -> DataFrame:
    """Merge title details into the pending titles and mark those as done; other rows stay as they are."""
    pending = pending_rows(titles, flag=flag, value="No")
    done = merge_answers(pending, answers, key, TITLE_POLICY).withColumn(flag, F.lit("Yes"))
    rest = titles.where(~F.coalesce(F.col(flag) == "No", F.lit(False)))
    return done.unionByName(rest, allowMissingColumns=True)


def normalised_title(title: Column) -> Column:
    return F.lower(F.trim(title))


def lookup_ids(
    titles: DataFrame, hits: DataFrame, title: str = "title", hit_id: str = "imdb_id", position: str = "position"
) -> DataFrame:
    """Give titles without an id the id of their top search hit; ``hits`` has (title, position, id) rows."""
    ranked = hits.select(
        normalised_title(F.col(title)).alias("__title"), F.col(position).alias("__position"),
        F.col(hit_id).alias("__hit"),
    ).where(F.col("__title").isNotNull())
    top = drop_duplicates_by_ordered_partition(ranked, "__title", ["__position", "__hit"]).drop("__position")
    titles = ensure_column_existence(titles, hit_id, "string")
    order = titles.columns
    joined = titles.withColumn("__title", normalised_title(F.col(title))).join(top, "__title", "left")
    return joined.withColumn(hit_id, F.coalesce(hit_id, "__hit")).select(*order)
