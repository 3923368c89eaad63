"""Rule ladders and the stars built on them."""

from pyspark.sql import functions as F

from reelsift.functions import rules
from reelsift.functions.values import map_literal
from reelsift.lookups import CATALOGUE_GENRE_RULES, RATING_CODES, TAG_RULES, Rule
from reelsift.operators.joins import map_column
from reelsift.plans import marts, stars
from reelsift.sources.readers import inline_table
from workload.registry import query

NAME_RULES = [
    Rule(".*ring.*", "jewel"),
    Rule(".*RED.*|.*blue.*", "colour"),
    Rule(r"\bgear$", "machine"),
    Rule("o[ld]{2}", "old stuff"),
    Rule("(s|l)[a-z]+", "size"),
]
FIRST = """CASE WHEN regexp_matches(p_name, '(?i)ring') THEN 'jewel' WHEN regexp_matches(p_name, '(?i)red|blue') THEN 'colour'
    WHEN regexp_matches(p_name, '(?i)\\bgear$') THEN 'machine' WHEN regexp_matches(p_name, '(?i)o[ld]{2}') THEN 'old stuff'
    WHEN regexp_matches(p_name, '(?i)(s|l)[a-z]+') THEN 'size' ELSE 'others' END"""


@query("f31_first_match", f"SELECT p_partkey, p_name, {FIRST} AS label FROM part")
def _(t):
    return t.part.select("p_partkey", "p_name", rules.first_match("p_name", NAME_RULES, "others").alias("label"))


@query("f31_per_distinct", f"SELECT p_partkey, p_name, {FIRST} AS label FROM part")
def _(t):
    return rules.apply_per_distinct(
        t.part.select("p_partkey", "p_name"), "p_name", "label", lambda c: rules.first_match(c, NAME_RULES, "others")
    )


@query(
    "f31_music_genres",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'rap' WHEN 'view' THEN 'metal' WHEN 'error' THEN 'punk'
       WHEN 'signup' THEN 'brazilian' ELSE 'others' END AS genre FROM events""",
)
def _(t):
    names = {"click": "Hip Hop Pop", "view": "trap METAL", "error": "skate punk", "signup": "Canto Brasileiro"}
    name = F.coalesce(map_literal(names)[F.col("event_type")], F.lit("polka"))
    return t.events.select("event_id", rules.map_genre(name).alias("genre"))


@query(
    "f32_last_match",
    r"""SELECT p_partkey, p_name, CASE WHEN regexp_matches(p_name, '(s|l)[a-z]+') THEN 'size' WHEN regexp_matches(p_name, 'o[ld]{2}') THEN 'old stuff'
        WHEN regexp_matches(p_name, '\bgear$') THEN 'machine' WHEN regexp_matches(p_name, 'RED|blue') THEN 'colour'
        WHEN regexp_matches(p_name, 'ring') THEN 'jewel' ELSE p_name END AS label FROM part""",
)
def _(t):
    return t.part.select("p_partkey", "p_name", rules.last_match("p_name", NAME_RULES).alias("label"))


CASCADE = "p_name"
for _pattern, _label in [
    (".*ring.*", "jewel"), (".*red.*|.*blue.*", "colour"), (r"\bgear$", "machine"), ("o[ld]{2}", "old stuff"), ("(s|l)[a-z]+", "size"),
]:
    CASCADE = f"regexp_replace({CASCADE}, '(?i){_pattern}', '{_label}', 'g')"


@query("f33_cascade", f"SELECT p_partkey, p_name, {CASCADE} AS label FROM part")
def _(t):
    return t.part.select("p_partkey", "p_name", rules.cascade("p_name", NAME_RULES).alias("label"))


@query(
    "f33_catalogue_genres",
    """SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'PROMO') THEN 'Sci-Fi & Fantasy' WHEN p_type = 'LARGE' THEN 'Comedy'
       WHEN p_type = 'ECONOMY' THEN 'Military and War' ELSE p_name END AS genres FROM part""",
)
def _(t):
    lists = {
        "SMALL": "TV Shows, FANTASY, Teen", "PROMO": "Action, Science Fiction", "LARGE": "Stand-up, comedies, dramas",
        "ECONOMY": "Docs of the warriors",
    }
    genre = F.coalesce(map_literal(lists)[F.col("p_type")], F.col("p_name"))
    return t.part.select("p_partkey", rules.cascade(genre, CATALOGUE_GENRE_RULES).alias("genres"))


@query(
    "f24_age_ratings",
    """SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 18 WHEN 'LARGE' THEN 7 WHEN 'PROMO' THEN 16 WHEN 'ECONOMY' THEN NULL END::BIGINT
       AS age_required FROM part""",
)
def _(t):
    codes = {"SMALL": "TV-MA", "LARGE": "PG", "PROMO": "16+", "ECONOMY": "NR"}
    code = map_literal(codes)[F.col("p_type")]
    ratings = inline_table(t.spark, list(RATING_CODES.items()), ["age_required", "min_age"])
    return map_column(t.part.select("p_partkey", code.alias("age_required")), ratings, "min_age", "age_required")


def tagged_parts(t):
    """Parts as videos: the words of the name are the tags."""
    return t.part.select(F.col("p_partkey").alias("video_id"), F.split(F.upper("p_name"), " ").alias("tags"))


def translations(t):
    """Translations of the words that occur in small parts."""
    words = t.part.where("p_size < 10").select(F.explode(F.split("p_name", " ")).alias("original_tag")).distinct()
    spelled = {"red": "gaming", "rod": "video game", "ring": "funny news", "old": "football"}
    translated = F.coalesce(map_literal(spelled)[F.col("original_tag")], F.col("original_tag"))
    return words.select("original_tag", translated.alias("translated_tag"))


STAR = """WITH words AS (SELECT DISTINCT p_partkey AS video_id, unnest(string_split(p_name, ' ')) AS tag FROM part),
    known AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS tag FROM part WHERE p_size < 10),
    translated AS (SELECT DISTINCT video_id, CASE WHEN known.tag IS NULL THEN '[OTHERS]' WHEN known.tag = 'red' THEN 'gaming'
        WHEN known.tag = 'rod' THEN 'gaming' WHEN known.tag = 'ring' THEN 'news' WHEN known.tag = 'old' THEN 'football'
        ELSE known.tag END AS tag FROM words LEFT JOIN known ON words.tag = known.tag),
    tags AS (SELECT tag, dense_rank() OVER (ORDER BY tag) AS tag_id FROM (SELECT DISTINCT tag FROM translated))"""


@query("d3_tag_bridge", f"{STAR} SELECT DISTINCT video_id, tag_id FROM translated JOIN tags USING (tag)")
def _(t):
    return stars.tag_star(tagged_parts(t), translations(t))[0]


@query("d3_tags", f"{STAR} SELECT tag_id, tag FROM tags")
def _(t):
    return stars.tag_star(tagged_parts(t), translations(t))[1]


def music(t):
    """Parts as music genres, customers as artists."""
    genres = t.part.select(F.col("p_partkey").alias("id_genre"), F.concat_ws(" ", "p_name", "p_type").alias("name_genre"))
    artists = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("id_artist"), F.col("c_name").alias("name_artist"))
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("id_artist"))
    pairs = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return genres, artists, pairs.select("id_artist", F.col("l_partkey").alias("id_genre"))


MUSIC_RULES = [Rule(".*old bolt.*", "rock"), Rule(".*promo.*", "pop"), Rule(".*gear.*", "metal")]
MUSIC = """WITH mapped AS (SELECT p_partkey, CASE WHEN contains(p_name, 'old bolt') THEN 'rock' WHEN p_type = 'PROMO' THEN 'pop'
        WHEN contains(p_name, 'gear') THEN 'metal' ELSE 'others' END AS name_genre FROM part),
    ids AS (SELECT name_genre, dense_rank() OVER (ORDER BY name_genre) AS id_genre FROM (SELECT DISTINCT name_genre FROM mapped)),
    pairs AS (SELECT DISTINCT o_custkey AS id_artist, id_genre, name_genre FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN mapped ON l_partkey = p_partkey JOIN ids USING (name_genre) JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0)"""


@query("d6_artist_genres", f"{MUSIC} SELECT id_artist, id_genre FROM pairs")
def _(t):
    genres, artists, pairs = music(t)
    return stars.genre_star(genres, artists, pairs, MUSIC_RULES, ids="dense")[0]


@query("d6_genres", f"{MUSIC} SELECT DISTINCT id_genre, name_genre FROM pairs")
def _(t):
    genres, artists, pairs = music(t)
    return stars.genre_star(genres, artists, pairs, MUSIC_RULES, ids="dense")[1]


@query("d6_genres_by_hash", f"{MUSIC} SELECT id_artist, name_genre FROM pairs")
def _(t):
    genres, artists, pairs = music(t)
    bridge, dimension = stars.genre_star(genres, artists, pairs, MUSIC_RULES)
    return bridge.join(dimension, "id_genre").select("id_artist", "name_genre")


def music_tables(t):
    """The raw music tables; genres are named by the shipped rules."""
    names = F.when(F.col("p_type") == "PROMO", "Hip Hop Pop").when(F.col("p_type") == "SMALL", "trap METAL").otherwise("polka")
    unknown = F.lit(None).cast("string")
    tracks = t.part.select(
        F.col("p_partkey").alias("id_track"), F.col("p_name").alias("name_track"), F.col("p_brand").alias("isrc"), F.col("p_size").alias("bpm"), unknown.alias("key"),
        F.col("p_type").alias("mode"), unknown.alias("release_date"), *[(F.col("p_size") / 50).alias(c) for c in stars.MUSIC_PROJECTIONS["tracks"][7:]], F.lit(1).alias("dropped"),
    )
    sold = t.lineitem.select(F.col("l_partkey").alias("id_track"), F.col("l_orderkey").alias("streams"), F.lit(1).alias("playlist_count"), F.col("l_linenumber").alias("popularity_track"), F.lit("x").alias("source_dataset"))
    artists = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("id_artist"), F.col("c_name").alias("name_artist"), F.col("c_mktsegment").alias("country"), unknown.alias("birth_date"), F.lit("Person").alias("type"), F.lit(1).alias("dropped")
    )
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("id_artist"))
    pairs = t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return {
        "tracks_stats": sold, "tracks": tracks, "artists": artists, "genres": t.part.select(F.col("p_partkey").alias("id_genre"), names.alias("name_genre")),
        "tracks_artists": pairs.select(F.col("l_partkey").alias("id_track"), "id_artist", (F.col("l_linenumber") == 1).alias("is_main_artist")),
        "artists_genres": pairs.select("id_artist", F.col("l_partkey").alias("id_genre")),
    }


SHIPPED = """WITH mapped AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'rap' WHEN 'SMALL' THEN 'metal' ELSE 'others' END AS name_genre FROM part)"""


@query(
    "d6_music_model",
    f"""{SHIPPED} SELECT DISTINCT o_custkey AS id_artist, c_name AS name_artist, name_genre FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN mapped ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0""",
)
def _(t):
    model = stars.music_entities(music_tables(t))
    named = model["artists_genre"].join(model["genres"], "id_genre")
    return named.join(model["artists"], "id_artist").select("id_artist", "name_artist", "name_genre")


@query(
    "d6_music_facts",
    """SELECT p_partkey AS id_track, p_name AS name_track, p_size AS bpm, p_size / 50 AS energy, c_custkey AS id_artist, l_linenumber = 1 AS is_main_artist, l_orderkey AS streams,
        l_linenumber AS popularity_track FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0""",
)
def _(t):
    model = stars.music_entities(music_tables(t))
    stats_of = model["tracks_stats"].join(t.orders.select(F.col("o_orderkey").alias("streams"), F.col("o_custkey").alias("id_artist")), "streams")
    main = F.col("popularity_track") == 1
    played = stats_of.join(model["tracks"], "id_track").join(model["artists"], "id_artist")
    known = model["tracks_artists"].distinct()
    return played.withColumn("is_main_artist", main).join(known, ["id_track", "id_artist", "is_main_artist"]).select(
        "id_track", "name_track", "bpm", "energy", "id_artist", "is_main_artist", "streams", "popularity_track"
    )


TAG_REPORT = """WITH tags AS (SELECT p_partkey AS video_id, CASE tag WHEN 'RED' THEN 'x' ELSE lower(tag) END AS main_tag
        FROM (SELECT p_partkey, unnest(string_split(upper(p_name), ' ')) AS tag FROM part)),
    counts AS (SELECT main_tag, count(*) AS main_tag_count FROM tags GROUP BY main_tag),
    top AS (SELECT main_tag FROM counts ORDER BY main_tag_count DESC, main_tag LIMIT 4),
    per_video AS (SELECT video_id, count(*) AS tags_count, count(*) FILTER (WHERE main_tag IN (FROM top)) AS top_x_tag_count,
        CAST(bool_or(main_tag IN (FROM top)) AS INTEGER) AS has_top_x_tag FROM tags GROUP BY video_id)"""


def tag_report(t):
    return marts.tag_condensing_report(tagged_parts(t), [*TAG_RULES, Rule("^red$", "x")], top=4)


@query("m11_tag_counts", f"{TAG_REPORT} FROM counts")
def _(t):
    return tag_report(t)["tag_counts"]


@query("m11_per_video", f"{TAG_REPORT} FROM per_video")
def _(t):
    return tag_report(t)["per_video"]


@query(
    "m11_coverage",
    f"""{TAG_REPORT} SELECT count(*) AS total_videos, sum(tags_count) / count(*) AS average_tags_per_video, 1.0::DOUBLE AS share_with_tags,
        sum(top_x_tag_count) / count(*) AS average_top_x_tags_per_video, sum(has_top_x_tag) / count(*) AS share_with_top_x_tag FROM per_video""",
)
def _(t):
    return tag_report(t)["coverage"]


@query("m11_histogram", f"{TAG_REPORT} SELECT tags_count, count(*) AS count FROM per_video GROUP BY tags_count")
def _(t):
    return tag_report(t)["histogram"]


@query("m11_nulls", "SELECT count(*) FILTER (WHERE p_partkey IS NULL) AS video_id_na, count(*) FILTER (WHERE p_name IS NULL) AS tags_na FROM part")
def _(t):
    return tag_report(t)["nulls"]
