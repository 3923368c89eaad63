"""Marts and cleaning plans over stand-ins: line items as trending rows, orders and parts as videos, parts as titles."""

from pyspark.sql import functions as F

from reelsift.functions.values import map_literal
from reelsift.lookups import Rule
from reelsift.operators.dims import create_association_table, create_unique_df
from reelsift.operators.quality import trailer_condition
from reelsift.plans import cleaning, marts, running, stars
from reelsift.sources import readers, writers
from workload.joining import PAGE_TITLES, WHOLE_WORD, page_titles
from workload.registry import REGISTRY, query

COUNTRIES = {0: "BR", 1: "US", 2: "JP", 3: "DE"}


def trending(t, video: str):
    """Line items as trending rows; the supplier's region gives the country, one of them unknown."""
    country = F.coalesce(map_literal(COUNTRIES)[F.col("n_regionkey")], F.lit("XX"))
    sold = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return sold.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col(video).alias("video_id"),
        F.col("l_shipdate").alias("trending_date"),
        country.alias("country_dataset"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("view_count"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint")).alias("likes"),
        F.col("l_linenumber").cast("bigint").alias("dislikes"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("comment_count"),
    )


TRENDING = """trending AS (SELECT {video} AS video_id, l_shipdate AS trending_date,
    CASE n_regionkey WHEN 0 THEN 'BR' WHEN 1 THEN 'US' WHEN 2 THEN 'JP' WHEN 3 THEN 'DE' ELSE 'XX' END AS country_dataset,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS view_count, CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END AS likes,
    CAST(l_linenumber AS BIGINT) AS dislikes, CAST(round(l_tax * 100) AS BIGINT) AS comment_count
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
BY_ORDER = TRENDING.format(video="l_orderkey")
BY_PART = TRENDING.format(video="l_partkey")


def order_videos(t):
    """Orders as videos of their customers' channels."""
    return t.orders.select(
        F.col("o_orderkey").alias("video_id"),
        F.col("o_custkey").alias("channel_id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_orderdate").alias("published_at"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("category_name"),
        F.lit(0).alias("comments_disabled"),
        F.lit(1).alias("ratings_disabled"),
        F.lit("en").alias("default_language"),
        F.lit("0.00:10:00").alias("duration"),
        F.lit(1).alias("caption"),
    )


@query(
    "m1_trending_with_details",
    f"""WITH {BY_ORDER} SELECT video_id, o_orderpriority AS title, c_name AS channel_title, trending_date, o_orderdate AS UTC_publish_date,
        country_dataset, view_count, likes, dislikes, comment_count, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS category_name,
        0 AS comments_disabled, 1 AS ratings_disabled, 'en' AS default_language, '0.00:10:00' AS duration, 1 AS caption,
        CASE country_dataset WHEN 'BR' THEN (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Sao_Paulo'
            WHEN 'US' THEN (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'
            WHEN 'JP' THEN (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Tokyo'
            WHEN 'DE' THEN (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' ELSE o_orderdate END AS local_publish_date
        FROM trending LEFT JOIN orders ON video_id = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0""",
)
def _(t):
    channels = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("channel_id"), F.col("c_name").alias("channel_title")
    )
    return marts.trending_with_details(trending(t, "l_orderkey"), order_videos(t), channels)


@query("m1_cobucketed", REGISTRY["m1_trending_with_details"].sql)
def _(t):
    channels = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("channel_id"), F.col("c_name").alias("channel_title"))
    database, base = t.database(), t.scratch()
    rows = trending(t, "l_orderkey").withColumn("year", F.year("trending_date"))
    # The facts arrive by years, the last year wrong at first; both tables are merged into and keep their buckets.
    writers.publish_cobucketed(rows.where("year < 1998").unionByName(rows.where("year > 1997").limit(100)), f"{database}.trending", "video_id", 8, base, ["year"], writers.BUCKET_ROWS)
    facts = writers.add_slice(rows.where("year > 1997"), f"{database}.trending")
    details = marts.video_details(order_videos(t), channels)
    writers.publish_cobucketed(details.withColumn("title", F.lit("old")).where("video_id % 2 = 0"), f"{database}.videos", "video_id", f"{database}.trending", base)
    return marts.trending_with_details(facts, writers.merge_updates(f"{database}.videos", details, "video_id", base_path=base))


TAGGED = """words AS (SELECT DISTINCT p_partkey AS video_id, unnest(string_split(p_name, ' ')) AS tag FROM part),
    tags AS (SELECT tag, dense_rank() OVER (ORDER BY tag) AS tag_id FROM (SELECT DISTINCT tag FROM words)),
    bridge AS (SELECT video_id, tag_id FROM words JOIN tags USING (tag))"""


def part_tags(t):
    """(bridge, tags) of the words in part names."""
    videos = t.part.select(F.col("p_partkey").alias("video_id"), F.split("p_name", " ").alias("tags"))
    words = videos.select(F.explode("tags").alias("original_tag")).distinct()
    same = words.withColumn("translated_tag", F.col("original_tag"))
    return stars.tag_star(videos, same, rules=[], ids="hash")


@query("m2_video_tags", f"WITH {TAGGED} SELECT video_id, tag FROM words")
def _(t):
    return marts.video_tags(*part_tags(t))


MEANS = ["avg_view_count", "avg_likes_count", "avg_likes_per_view"]


def rounded(df, names, digits=4):
    return df.withColumns({name: F.round(name, digits) for name in names})


@query(
    "m3_tag_statistics",
    f"""WITH {BY_PART}, {TAGGED}, first AS (SELECT * FROM trending QUALIFY row_number() OVER (PARTITION BY video_id
            ORDER BY trending_date, country_dataset, view_count DESC) = 1)
        SELECT tag, count(*) AS videos_count, round(avg(view_count), 4) AS avg_view_count, round(avg(likes), 4) AS avg_likes_count,
            round(avg(likes / view_count), 4) AS avg_likes_per_view
        FROM first JOIN bridge USING (video_id) JOIN tags USING (tag_id) WHERE view_count > 1000000 AND tag <> 'red'
        GROUP BY tag HAVING count(*) > 100""",
)
def _(t):
    return rounded(marts.tag_statistics(trending(t, "l_partkey"), *part_tags(t), exclude="red"), MEANS)


@query(
    "m4_top_tags",
    f"""WITH {BY_PART}, {TAGGED}, means AS (SELECT tag, country_dataset, count(*) AS videos_count, round(avg(view_count), 4) AS avg_view_count,
            round(avg(likes), 4) AS avg_likes_count, round(avg(likes / view_count), 9) AS avg_likes_per_view
            FROM trending JOIN bridge USING (video_id) JOIN tags USING (tag_id) WHERE view_count > 1000000 AND tag <> 'red'
            GROUP BY tag, country_dataset)
        SELECT *, CAST(row_number() OVER (PARTITION BY country_dataset ORDER BY videos_count DESC, tag) AS INTEGER) AS tag_country_rank
        FROM means QUALIFY tag_country_rank <= 10""",
)
def _(t):
    top = marts.top_tags_per_country(trending(t, "l_partkey"), *part_tags(t), k=10, exclude="red")
    return rounded(rounded(top, MEANS[:2]), MEANS[2:], 9)


@query(
    "m4_top_tags_by_video",
    f"""WITH {BY_PART}, {TAGGED}, means AS (SELECT tag, country_dataset, count(DISTINCT video_id) AS videos_count
            FROM trending JOIN bridge USING (video_id) JOIN tags USING (tag_id) WHERE view_count > 1000000 GROUP BY tag, country_dataset)
        SELECT *, CAST(row_number() OVER (PARTITION BY country_dataset ORDER BY videos_count DESC, tag) AS INTEGER) AS tag_country_rank
        FROM means""",
)
def _(t):
    return marts.top_tags_per_country(trending(t, "l_partkey"), *part_tags(t), count_videos=True).drop(*MEANS)


CATEGORISED = f"""WITH {BY_ORDER}, categorised AS (SELECT country_dataset, trending_date, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END
    AS category_name FROM trending LEFT JOIN orders ON video_id = o_orderkey)"""


@query(
    "m5_category_distribution",
    f"""{CATEGORISED}, scoped AS (SELECT country_dataset, category_name FROM categorised UNION ALL SELECT 'ALL', category_name FROM categorised),
        counts AS (SELECT country_dataset, category_name, count(*) AS videos_in_category_per_country FROM scoped GROUP BY ALL)
        SELECT *, round(videos_in_category_per_country / (sum(videos_in_category_per_country) OVER (PARTITION BY country_dataset)), 9)
            AS percent_of_country_trending_videos FROM counts""",
)
def _(t):
    return rounded(
        marts.category_distribution(trending(t, "l_orderkey"), order_videos(t)), ["percent_of_country_trending_videos"], 9
    )


@query(
    "m6_monthly_categories",
    f"""{CATEGORISED} SELECT category_name, country_dataset, date_trunc('month', trending_date) AS month,
        count(*) AS videos_in_category_per_month FROM categorised GROUP BY ALL""",
)
def _(t):
    return marts.monthly_category_distribution(trending(t, "l_orderkey"), order_videos(t))


def part_shows(t):
    """Parts as titles: the words of the name are genres, the type is the platform, the brand the country."""
    return t.part.select(
        F.col("p_partkey").alias("show_id"),
        F.replace("p_name", F.lit(" "), F.lit(", ")).alias("genres"),
        F.col("p_type").alias("platform"),
        F.col("p_brand").alias("countries"),
        F.when(F.col("p_size") > 25, "Movie").when(F.col("p_size") > 5, "TV Show").otherwise("Short").alias("category"),
        F.nullif(F.col("p_retailprice"), F.lit(900.0)).alias("cumulative_worldwide_gross_eur"),
        (F.col("p_size") / 5.0).alias("rating"),
        F.when(F.col("p_size") != 7, F.col("p_size").cast("string")).alias("votes"),
    )


YEARS = ["year(trending_date) < 1995", "year(trending_date) IN (1995, 1996)", "year(trending_date) > 1996"]


def state_by_slices(t, video: str):
    """Three slices of whole years; the middle one comes wrong at first, and the last one in two parts."""
    rows, state = trending(t, video), running.TrendingState(t.spark, t.database(), "trending_state", period="year")
    wrong = rows.where(YEARS[1]).withColumn("view_count", F.col("view_count") * 3)
    state.absorb(rows.where(YEARS[0]))
    state.absorb(wrong)
    state.absorb(rows.where(YEARS[2]).where("dislikes <= 3"))
    state.absorb(rows.where(YEARS[2]).where("dislikes > 3"), whole_periods=False)
    state.absorb(rows.where(YEARS[1]))
    return state


@query("m3_by_slices", REGISTRY["m3_tag_statistics"].sql)
def _(t):
    return rounded(state_by_slices(t, "l_partkey").tag_statistics(*part_tags(t), exclude="red"), MEANS)


@query("m4_by_slices", REGISTRY["m4_top_tags"].sql)
def _(t):
    top = state_by_slices(t, "l_partkey").top_tags_per_country(*part_tags(t), k=10, exclude="red")
    return rounded(rounded(top, MEANS[:2]), MEANS[2:], 9)


@query("m5_by_slices", REGISTRY["m5_category_distribution"].sql)
def _(t):
    shares = state_by_slices(t, "l_orderkey").category_distribution(order_videos(t))
    return rounded(shares, ["percent_of_country_trending_videos"], 9)


@query("m6_by_slices", REGISTRY["m6_monthly_categories"].sql.replace("date_trunc('month', trending_date)", "CAST(date_trunc('month', trending_date) AS DATE)"))
def _(t):
    return state_by_slices(t, "l_orderkey").monthly_category_distribution(order_videos(t))


STATS = """count(*) AS count_of_shows_movies, round(sum(nullif(p_retailprice, 900.0)), 2) AS total_gross_eur, round(avg(p_size / 5.0), 2) AS average_rating,
    round(avg(nullif(p_size, 7)), 2) AS average_votes FROM part"""


def catalogue_mart(t, mart, column, name, id_name):
    shows = part_shows(t)
    dimension = create_unique_df(shows, column, name, id_name)
    bridge = create_association_table(shows, None, column, name, "show_id", id_name)
    return mart(shows, bridge, dimension)


@query(
    "m7_by_genre",
    f"SELECT genre_name, {STATS} JOIN (SELECT p_partkey AS k, unnest(string_split(p_name, ' ')) AS genre_name FROM part) ON k = p_partkey GROUP BY genre_name",
)
def _(t):
    return rounded(catalogue_mart(t, marts.catalogue_by_genre, "genres", "genre_name", "genre_id"), ["total_gross_eur"], 2)


@query("m8_by_platform", f"SELECT p_type AS platform_name, {STATS} GROUP BY p_type")
def _(t):
    return rounded(catalogue_mart(t, marts.catalogue_by_platform, "platform", "platform_name", "platform_id"), ["total_gross_eur"], 2)


@query(
    "m9_by_country",
    """SELECT p_brand AS country_name, nullif(count(*) FILTER (WHERE p_size > 25), 0) AS count_of_movies,
       nullif(count(*) FILTER (WHERE p_size > 5 AND p_size <= 25), 0) AS count_of_tv_shows,
       count(*) FILTER (WHERE p_size > 5) AS count_of_both FROM part GROUP BY p_brand""",
)
def _(t):
    return catalogue_mart(t, marts.catalogue_by_country, "countries", "country_name", "country_id")


@query(
    "m10_best_trailers",
    f"""WITH {BY_ORDER}, shows AS ({PAGE_TITLES}),
        videos AS (SELECT doc_id, text FROM documents WHERE contains(lower(text), 'th') AND lower(lang) <> 'de'
            AND NOT regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(heat|onred)($|[^\\p{{L}}\\p{{N}}_])')),
        near AS MATERIALIZED (SELECT page_id, title, doc_id, text FROM shows JOIN videos ON length(title) > 5 AND contains(lower(text), lower(title))),
        matched AS (SELECT page_id, title, doc_id, text FROM near WHERE {WHOLE_WORD.format(text='text', title='title')}),
        peaks AS (SELECT video_id, max(view_count) AS view_count, max(likes) AS likes, max(dislikes) AS dislikes,
            max(comment_count) AS comment_count FROM trending GROUP BY video_id)
        SELECT page_id AS show_id, title AS streaming_title, doc_id AS video_id, md5(text) AS video_title, view_count, likes, dislikes, comment_count
        FROM matched JOIN peaks ON doc_id = video_id WHERE view_count IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY page_id ORDER BY view_count DESC) = 1""",
)
def _(t):
    shows = page_titles(t).select(
        F.col("page_id").alias("show_id"), "title", F.lit(1).alias("votes"), F.lit(1.0).alias("cumulative_worldwide_gross_eur")
    )
    videos = t.documents.select(F.col("doc_id").alias("video_id"), F.col("text").alias("title"), F.col("lang").alias("category_name"))
    candidate = trailer_condition(F.col("title"), F.col("category_name"), "th", ["heat", "onred"], ("DE",))
    best = marts.best_trailers(shows, videos, trending(t, "l_orderkey"), candidate, long_texts=True)
    return best.withColumn("video_title", F.md5("video_title")).drop("votes", "cumulative_worldwide_gross_eur")


def raw_catalogue(t):
    """Parts as raw catalogue rows, with the faults that cleaning repairs."""
    ratings = F.when(F.col("p_type") == "SMALL", "TV-MA").when(F.col("p_type") == "LARGE", "74 min").otherwise("PG-13")
    added = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")), "MMMM d, yyyy")
    return t.part.select(
        F.concat(F.lit("s"), F.format_string("%08d", "p_partkey")).alias("show_id"),
        F.when(F.col("p_size") > 25, "Movie").otherwise("TV Show").alias("category"),
        ratings.alias("age_required"),
        F.concat_ws(" ", "p_name", "p_brand").alias("title"),
        F.lit("D").alias("director"),
        F.lit("A, B").alias("cast"),
        F.concat(F.lit(", "), "p_brand").alias("countries"),
        added.alias("date_added"),
        F.lit(2020).alias("release_year"),
        F.when(F.col("p_type") != "LARGE", "2 Seasons").alias("duration"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("Anime Series, "), "p_name")).alias("genres"),
        F.col("p_type").alias("platform"),
        F.lit("2024-01-02").alias("last_updated_date"),
    )


@query(
    "k1_raw_catalogue",
    """WITH rows AS (SELECT 's' || lpad(p_partkey::VARCHAR, 8, '0') AS show_id, CASE WHEN p_size > 25 THEN 'Movie' ELSE 'TV Show' END AS category,
            CASE p_type WHEN 'SMALL' THEN 18 WHEN 'LARGE' THEN NULL ELSE 13 END AS age_required,
            coalesce(s_name, p_name || ' ' || p_brand) AS title, 'D' AS director, 'A, B' AS cast, p_brand AS countries,
            CAST(DATE '2020-01-01' + p_size AS DATE) AS date_added, 2020 AS release_year,
            CASE WHEN p_type = 'LARGE' THEN '74 min' ELSE '2 Seasons' END AS duration,
            CASE WHEN p_type <> 'PROMO' THEN 'Anime Series, ' || p_name END AS genres,
            CASE WHEN p_type <> 'PROMO' THEN 'yes' ELSE 'no' END AS is_animation, p_type AS platform, 'No' AS is_scraped,
            DATE '2024-01-02' AS last_updated_date FROM part LEFT JOIN supplier ON p_partkey = s_suppkey)
        SELECT * FROM rows WHERE NOT starts_with(title, 'red') QUALIFY row_number() OVER (PARTITION BY title ORDER BY show_id) = 1""",
)
def _(t):
    overrides = t.supplier.select(
        F.concat(F.lit("s"), F.format_string("%08d", "s_suppkey")).alias("show_id"), F.col("s_name").alias("title_translation")
    )
    return cleaning.clean_raw_catalogue(raw_catalogue(t), overrides=overrides, file_date="2024-01-02", removed_prefixes=["red"])


@query(
    "k2_enriched_catalogue",
    """WITH rows AS (SELECT p_partkey AS show_id, p_name AS title, p_brand AS platform,
            CASE WHEN p_size > 25 THEN 'Movie' ELSE 'TV Show' END AS category, p_size, p_type,
            CASE WHEN p_size <> 3 THEN round(p_size / 92.8401, 0) END AS budget_eur, round(floor(p_retailprice) / 1.1082, 0) AS gross FROM part)
        SELECT show_id, title, platform, category, CASE WHEN p_size < 10 THEN DATE '2012-06-15' ELSE DATE '2012-01-01' END AS release_date,
            round(p_size / 7.0, 2) AS rating, CASE WHEN category = 'Movie' THEN p_size END AS duration_minutes,
            CASE WHEN category = 'TV Show' THEN p_size END AS duration_seasons, 2011 AS first_series_years,
            CASE WHEN p_size < 20 THEN 2019 END AS last_series_years, budget_eur, NULL::DOUBLE AS opening_weekend_eur,
            gross AS cumulative_worldwide_gross_eur, CASE WHEN p_type = 'SMALL' THEN 'Kids' ELSE p_type END AS genres,
            DATE '2024-05-06' AS last_updated_date FROM rows WHERE budget_eur >= 0.4 OR budget_eur IS NULL
        QUALIFY row_number() OVER (PARTITION BY title, platform ORDER BY show_id) = 1""",
)
def _(t):
    size = F.col("p_size").cast("string")
    budget = F.when(F.col("p_size") != 3, F.concat(F.lit("Budget=INR"), size, F.lit(" (estimated), "))).otherwise("")
    gross = F.concat(F.lit("Cumulative Worldwide Gross=$"), F.format_number(F.floor("p_retailprice"), 0))
    enriched = t.part.select(
        F.col("p_partkey").alias("show_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("platform"),
        F.when(F.col("p_size") > 25, "Movie").otherwise("TV Show").alias("category"),
        F.when(F.col("p_size") < 10, "15 Jun 2012 (USA)").otherwise("2012").alias("release_date"),
        (F.col("p_size") / 7.0).cast("string").alias("rating"),
        F.concat(size, F.lit(" min")).alias("duration"),
        F.when(F.col("p_size") < 20, "2011-2019").otherwise("2011-").alias("series_years"),
        F.concat(F.lit("{"), budget, gross, F.lit("}")).alias("box_office"),
        F.when(F.col("p_type") == "SMALL", "Teen, KIDS TV").otherwise(F.col("p_type")).alias("genres"),
        F.lit("2020-01-01").cast("date").alias("last_updated_date"),
    )
    rules = [Rule(".*kids.*", "Kids"), Rule(".*teen.*", "Teen")]
    return cleaning.clean_enriched_catalogue(enriched, genre_rules=rules, run_date="2024-05-06", minimum_budget=0.4)


def raw_trending(t):
    """Line items in the layout of the raw trending files."""
    return trending(t, "l_partkey").select(
        F.col("video_id").cast("string").alias("video_id"),
        F.concat(F.lit("video "), F.col("video_id").cast("string")).alias("title"),
        F.col("trending_date").alias("publishedAt"),
        F.concat(F.lit("c"), F.col("dislikes").cast("string")).alias("channelId"),
        F.lit("channel").alias("channelTitle"),
        F.lit(10).alias("categoryId"),
        "trending_date",
        F.when(F.col("comment_count") < 5, "[None]").otherwise("a|b").alias("tags"),
        "view_count", "likes", "dislikes", "comment_count",
        F.lit("link").alias("thumbnail_link"),
        (F.col("dislikes") > 3).alias("comments_disabled"),
        F.lit(False).alias("ratings_disabled"),
        F.lit("Music").alias("category_name"),
        "country_dataset",
    )


CLEANED = f"""WITH {BY_PART}, cleaned AS (SELECT * FROM trending QUALIFY row_number() OVER (PARTITION BY video_id, trending_date, country_dataset
    ORDER BY view_count DESC, likes DESC NULLS LAST, dislikes) = 1)"""


@query(
    "k3_trending_cleaned",
    f"""{CLEANED} SELECT video_id::VARCHAR AS video_id, trending_date, trending_date AS published_at, country_dataset, view_count, likes,
        CASE WHEN comment_count >= 5 THEN 'a,b' END AS tags, CAST(dislikes > 3 AS INTEGER) AS comments_disabled FROM cleaned""",
)
def _(t):
    cleaned = cleaning.trending_initial_cleaning(raw_trending(t))
    return cleaned.select(
        "video_id", "trending_date", "published_at", "country_dataset", "view_count", "likes",
        F.array_join("tags", ",").alias("tags"), "comments_disabled",
    )


@query(
    "k4_merged_videos",
    f"""{CLEANED} SELECT video_id::VARCHAR AS video_id, trending_date, country_dataset, view_count, 0 AS is_scraped,
        dislikes > 3 AS comments_disabled, NULL::VARCHAR AS duration FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY trending_date DESC, country_dataset) = 1""",
)
def _(t):
    return cleaning.merged_videos(raw_trending(t)).select(
        "video_id", "trending_date", "country_dataset", "view_count", "is_scraped", "comments_disabled", "duration"
    )


@query(
    "j4_silver_videos",
    f"""{CLEANED}, latest AS (SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY trending_date DESC, country_dataset) = 1)
        SELECT video_id::VARCHAR AS video_id, 'c' || dislikes AS channel_id, 1 AS is_scraped, '0.00:0' || (p_size % 10) || ':00' AS duration,
        CASE WHEN p_type = 'SMALL' THEN 1 ELSE 0 END AS caption, CAST(p_size > 25 AS INTEGER) AS licensed_content
        FROM latest JOIN part ON video_id = p_partkey WHERE p_type <> 'PROMO'""",
)
def _(t):
    enriched = t.part.where("p_type <> 'PROMO'").select(
        F.col("p_partkey").cast("string").alias("video_id"),
        F.split("p_name", " ").alias("tags"),
        F.lit(1).alias("is_scraped"),
        F.lit("en").alias("default_language"),
        F.concat(F.lit("PT"), (F.col("p_size") % 10).cast("string"), F.lit("M")).alias("duration"),
        F.when(F.col("p_type") == "SMALL", "true").otherwise("False").alias("caption"),
        (F.col("p_size") > 25).alias("licensed_content"),
        F.lit(None).cast("map<string, array<string>>").alias("region_restriction"),
        F.lit(None).cast("map<string, string>").alias("content_rating"),
    )
    return cleaning.silver_videos(raw_trending(t), enriched).select(
        "video_id", "channel_id", "is_scraped", "duration", "caption", "licensed_content"
    )


def through_the_table(t, rows, run_date):
    """The rows as they come back from a table that held older versions of half of them, without some of their values."""
    database, base = t.database(), t.scratch()
    older = rows.where(F.pmod(F.xxhash64("show_id"), F.lit(2)) == 0).withColumns({"genres": F.lit("old"), "category": F.lit(None).cast("string")})
    writers.publish_bucketed(older, f"{database}.shows", "show_id", 8, base)
    view = f"{database}_updates"
    writers.expose_view(rows, view)
    writers.merge_tables(t.spark, database, "shows", view, run_date=run_date, base_path=base)
    return readers.read_table(t.spark, database, "shows").drop(writers.KEY_BUCKET)


@query("k1_merged", REGISTRY["k1_raw_catalogue"].sql)
def _(t):
    return through_the_table(t, REGISTRY["k1_raw_catalogue"].run(t), "2024-01-02")


@query("k2_merged", REGISTRY["k2_enriched_catalogue"].sql)
def _(t):
    return through_the_table(t, REGISTRY["k2_enriched_catalogue"].run(t), "2024-05-06")
