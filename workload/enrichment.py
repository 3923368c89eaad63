"""JSON answers to columns, and merges of answers into tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.functions import landed
from reelsift.operators import enrich
from reelsift.plans import resumable
from reelsift.session import durable
from reelsift.sources import writers
from workload.registry import query


def answers(df, keep, **fields):
    """Rows with a JSON answer built from columns."""
    body = F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))
    return df.select(*keep, body.alias("response"))


@query("f34_event_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query(
    "f34_video_answers",
    """SELECT p_partkey::VARCHAR AS video_id, replace(p_name, ' ', ',') AS tags, CASE WHEN p_size > 10 THEN 'en' END AS default_language,
       'PT' || p_size || 'M' AS duration, 'true' AS caption, p_size > 25 AS licensed_content,
       CASE WHEN p_type = 'PROMO' THEN 'DE,FR' END AS blocked, p_type AS rating FROM part""",
)
def _(t):
    raw = answers(
        t.part, [],
        id=F.col("p_partkey").cast("string"),
        snippet=F.struct(
            F.split("p_name", " ").alias("tags"), F.when(F.col("p_size") > 10, "en").alias("defaultLanguage")
        ),
        contentDetails=F.struct(
            F.concat(F.lit("PT"), F.col("p_size").cast("string"), F.lit("M")).alias("duration"),
            F.lit("true").alias("caption"),
            (F.col("p_size") > 25).alias("licensedContent"),
            F.when(F.col("p_type") == "PROMO", F.create_map(F.lit("blocked"), F.array(F.lit("DE"), F.lit("FR")))).alias("regionRestriction"),
            F.create_map(F.lit("rating"), F.col("p_type")).alias("contentRating"),
        ),
    )
    flat = landed.video_columns(raw)
    return flat.select(
        "video_id", F.array_join("tags", ",").alias("tags"), "default_language", "duration", "caption", "licensed_content",
        F.array_join(F.col("region_restriction")["blocked"], ",").alias("blocked"), F.col("content_rating")["rating"].alias("rating"),
    )


@query(
    "f35_track_answers",
    """SELECT p_name AS name_track, p_brand || ', ' || p_type AS name_artist_list, 'a, b' AS id_artist_list, p_type AS name_album,
       'i' || p_partkey AS isrc, p_partkey::VARCHAR AS id_track, CAST(p_size > 25 AS INTEGER) AS is_explicit,
       p_size / 100.0::DOUBLE AS popularity_track, p_brand AS id_album FROM part""",
)
def _(t):
    raw = answers(
        t.part, [],
        id=F.col("p_partkey").cast("string"),
        name=F.col("p_name"),
        artists=F.array(
            F.struct(F.col("p_brand").alias("name"), F.lit("a").alias("id")), F.struct(F.col("p_type").alias("name"), F.lit("b").alias("id"))
        ),
        album=F.struct(F.col("p_type").alias("name"), F.col("p_brand").alias("id")),
        external_ids=F.struct(F.concat(F.lit("i"), F.col("p_partkey").cast("string")).alias("isrc")),
        explicit=F.col("p_size") > 25,
        popularity=F.col("p_size"),
    )
    return landed.track_columns(raw)


@query(
    "f35_artist_answers",
    """SELECT c_name AS name_artist, lower(c_mktsegment) || ',x' AS genres, c_nationkey / 100.0::DOUBLE AS popularity_artist,
       c_custkey::VARCHAR AS id_artist, c_custkey * 10 AS followers FROM customer""",
)
def _(t):
    raw = answers(
        t.customer, [],
        id=F.col("c_custkey").cast("string"), name=F.col("c_name"), genres=F.array(F.lower("c_mktsegment"), F.lit("x")),
        popularity=F.col("c_nationkey"), followers=F.struct((F.col("c_custkey") * 10).alias("total")),
    )
    return landed.artist_columns(raw).withColumn("genres", F.array_join("genres", ","))


@query(
    "f35_album_answers",
    """SELECT o_orderkey::VARCHAR AS id_album, o_orderpriority AS name_album, 'single' AS album_type,
       strftime(o_orderdate, '%Y-%m-%d') AS release_date, NULL::VARCHAR AS label, 0.5::DOUBLE AS popularity_album,
       CAST(o_custkey AS INTEGER) AS no_of_tracks FROM orders""",
)
def _(t):
    raw = answers(
        t.orders, [],
        id=F.col("o_orderkey").cast("string"), name=F.col("o_orderpriority"), album_type=F.lit("single"),
        release_date=F.date_format("o_orderdate", "yyyy-MM-dd"), popularity=F.lit(50), total_tracks=F.col("o_custkey"),
    )
    return landed.album_columns(raw)


@query(
    "f35_audio_answers",
    """SELECT p_partkey::VARCHAR AS id_track, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][p_size % 12 + 1] AS key,
       CASE WHEN p_size % 2 = 1 THEN 'Major' ELSE 'Minor' END AS mode, '0.25' AS danceability, NULL::VARCHAR AS energy, NULL::VARCHAR AS speechiness,
       NULL::VARCHAR AS acousticness, NULL::VARCHAR AS instrumentalness, NULL::VARCHAR AS liveness, p_size::VARCHAR AS bpm, '0.5' AS valence FROM part""",
)
def _(t):
    raw = answers(
        t.part, [],
        id=F.col("p_partkey").cast("string"), key=F.col("p_size") % 12, mode=F.col("p_size") % 2, tempo=F.col("p_size") + 0.75,
        danceability=F.lit(0.25), valence=F.lit(0.5),
    )
    return landed.audio_feature_columns(raw)


def title_answers(parts):
    """Answers for parts, in the layout of a film database."""
    person = lambda name: F.struct(name.alias("name"))
    df = parts.select("*", F.col("p_partkey").cast("string").alias("imdb_id"))
    fields = {
        "countries": F.array("p_brand", "p_type"),
        "rating": F.col("p_size") / 10,
        "votes": F.col("p_size") * 100,
        "color": F.array(F.when(F.col("p_type") == "SMALL", "Color").otherwise("Black and White")),
        "top 250 rank": F.when(F.col("p_size") > 40, F.col("p_size")),
        "box office": F.concat(F.lit("Budget=$"), F.col("p_size").cast("string")),
        "cast": F.array(person(F.col("p_name")), person(F.col("p_brand"))),
        "director": F.when(F.col("p_type") != "PROMO", F.array(person(F.col("p_type")))),
        "series years": F.lit("2011-"),
    }
    return answers(df, ["imdb_id"], **fields)


@query(
    "f36_title_answers",
    """SELECT p_partkey::VARCHAR AS imdb_id, p_brand || ', ' || p_type AS countries, p_size / 10.0::DOUBLE AS rating, CAST(p_size * 100 AS BIGINT) AS votes,
       NULL::VARCHAR AS languages, CASE WHEN p_type = 'SMALL' THEN 'Yes' ELSE 'No' END AS color,
       CASE WHEN p_size > 40 THEN 'Yes' ELSE 'No' END AS top_250, 'Budget=$' || p_size AS box_office, p_name || ', ' || p_brand AS cast,
       CASE WHEN p_type <> 'PROMO' THEN p_type END AS director, NULL::VARCHAR AS production_companies, NULL::VARCHAR AS writers,
       '2011-' AS series_years, NULL::VARCHAR AS release_date FROM part""",
)
def _(t):
    return landed.title_columns(title_answers(t.part))


@query(
    "e3_new_value_first",
    """SELECT c_custkey, coalesce(s_name, c_name) AS c_name, coalesce(nullif(s_acctbal, 73.0), c_acctbal) AS c_acctbal
       FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def _(t):
    new = t.supplier.select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.nullif("s_acctbal", F.lit(73.0)).alias("c_acctbal")
    )
    policy = {"c_name": enrich.NEW_FIRST, "c_acctbal": enrich.NEW_FIRST}
    return enrich.merge_answers(t.customer.select("c_custkey", "c_name", "c_acctbal"), new, "c_custkey", policy)


@query(
    "e3_missing_filled",
    """SELECT o_orderkey, coalesce(q, CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END) AS price, q AS lines
       FROM orders LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS q FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
)
def _(t):
    df = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("price"))
    new = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("price"))
    return enrich.fill_missing_data(df, new.withColumn("lines", F.col("price")), "o_orderkey", ["price", "lines"])


@query(
    "e4_mixed_precedence",
    """SELECT p_partkey AS show_id, CASE WHEN pending AND found AND p_type <> 'PROMO' THEN p_type ELSE 'old' END AS director,
       CASE WHEN pending AND found THEN p_name || ', ' || p_brand ELSE 'old' END AS cast,
       CASE WHEN pending AND found THEN p_size / 10.0::DOUBLE WHEN pending THEN NULL ELSE 1.0 END AS rating,
       CASE WHEN pending THEN 'Yes' ELSE 'Done' END AS is_scraped
       FROM (SELECT *, p_size > 10 AS found, p_type <> 'SMALL' AS pending FROM part)""",
)
def _(t):
    titles = t.part.select(
        F.col("p_partkey").alias("show_id"),
        F.col("p_partkey").cast("string").alias("imdb_id"),
        F.lit("old").alias("director"),
        F.lit("old").alias("cast"),
        F.lit("old").alias("countries"),
        F.lit("2012").alias("release_date"),
        F.lit(1.0).alias("rating"),
        F.when(F.col("p_type") != "SMALL", "No").otherwise("Done").alias("is_scraped"),
    )
    merged = enrich.enrich_titles(titles, landed.title_columns(title_answers(t.part.where("p_size > 10"))))
    return merged.select("show_id", "director", "cast", "rating", "is_scraped")


@query(
    "e5_ids_by_title",
    """SELECT c_custkey, c_mktsegment AS title, hit AS imdb_id FROM customer LEFT JOIN (SELECT o_orderpriority, min_by(o_orderkey, o_totalprice)::VARCHAR AS hit
       FROM orders GROUP BY o_orderpriority) ON substr(o_orderpriority, 1, 1) = c_nationkey::VARCHAR""",
)
def _(t):
    written = F.concat(F.lit(" T"), F.col("c_nationkey").cast("string"))
    titles = t.customer.select("c_custkey", "c_mktsegment", written.alias("title"))
    hits = t.orders.select(
        F.concat(F.lit("t"), F.substring("o_orderpriority", 1, 1)).alias("title"),
        F.col("o_totalprice").alias("position"),
        F.col("o_orderkey").cast("string").alias("imdb_id"),
    )
    found = enrich.lookup_ids(titles, hits)
    return found.select("c_custkey", F.col("c_mktsegment").alias("title"), "imdb_id")


@query(
    "e5_top_search_hit",
    "SELECT p_partkey, CASE WHEN p_type <> 'PROMO' THEN p_name END AS imdb_id FROM part",
)
def _(t):
    hit = F.array(F.struct(F.col("p_name").alias("movieID"), F.lit("x").alias("title")), F.struct(F.col("p_brand").alias("movieID"), F.lit("y").alias("title")))
    body = F.to_json(F.when(F.col("p_type") == "PROMO", F.slice(hit, 1, 0)).otherwise(hit))
    return t.part.select("p_partkey", landed.top_search_hit(body).alias("imdb_id"))


@query(
    "e6_found_and_not_found",
    """SELECT p_partkey AS video_id, CASE WHEN p_type = 'SMALL' THEN 'old' WHEN p_size > 10 THEN p_name END AS duration,
       CASE WHEN p_type = 'SMALL' THEN 1 WHEN p_size > 10 THEN 1 ELSE -1 END AS is_scraped FROM part""",
)
def _(t):
    videos = t.part.select(
        F.col("p_partkey").alias("video_id"),
        F.when(F.col("p_type") == "SMALL", "old").alias("duration"),
        F.when(F.col("p_type") == "SMALL", 1).otherwise(0).alias("is_scraped"),
    )
    found = t.part.where("p_size > 10").select(F.col("p_partkey").alias("video_id"), F.col("p_name").alias("duration"))
    return enrich.enrich_videos(videos, found)


@query(
    "e1_resumed_run",
    """SELECT c_custkey, c_name || '!' AS answer, 1 AS asked, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / (SELECT ceil(count(*) / 5) FROM customer)) AS BIGINT) AS batch_id
       FROM customer""",
)
def _(t):
    base, table = t.scratch(), f"{t.database()}.answers"
    size = -(-t.customer.count() // 5)
    names = t.customer.select(F.col("c_custkey").alias("id"), "c_name")
    writers.publish_bucketed(t.customer.limit(0).select(F.col("c_custkey").alias("id"), F.lit("").alias("answer")), table, "id", 4, base)
    asked = []

    def ask(ids):
        if len(asked) == 2 and not started_again:
            raise ConnectionError("the service is gone")
        asked.append(durable(ids))
        return ids.join(names, "id").select("id", F.concat("c_name", F.lit("!")).alias("answer"))

    started_again = False
    for _ in range(2):
        run = resumable.EnrichmentRun(t.spark, "names", base)
        run.plan(t.customer, "c_custkey", size)
        try:
            run.run(ask, lambda answers: writers.merge_updates(table, answers, "id", base_path=base))
        except ConnectionError:
            started_again = True  # after two of five batches
    times = reduce(DataFrame.unionByName, asked).groupBy("id").agg(F.count("*").cast("int").alias("asked"))
    told = t.spark.table(table).join(times, "id").join(run.ids(), "id")
    return told.select(F.col("id").alias("c_custkey"), "answer", "asked", F.col("batch_id").cast("bigint").alias("batch_id"))
