"""Aggregates, shares, windows, ids, unions and explodes."""

from pyspark.sql import functions as F

from reelsift.operators import dedup, dims, ranking, reshape, stats
from reelsift.operators.quality import flag_members
from reelsift.operators.schema import ensure_list_column
from workload.registry import query


@query(
    "a1_group_counts",
    """SELECT p_type, p_brand, count(p_type) AS p_type_count, count(p_brand) AS p_brand_count
       FROM (SELECT nullif(p_type, 'PROMO') AS p_type, p_brand FROM part) GROUP BY p_type, p_brand""",
)
def _(t):
    df = t.part.select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"), "p_brand")
    return stats.group_by_count(df, ["p_type", "p_brand"])


def sold_by_nation(t):
    sold = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return sold.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


SOLD = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"


@query(
    "a2_summary",
    f"""SELECT n_name, count(*) AS sold, sum(l_linenumber)::BIGINT AS lines, round(avg(l_quantity), 2) AS average_quantity,
        round(avg(l_discount), 2) AS average_discount FROM {SOLD} GROUP BY n_name""",
)
def _(t):
    return stats.summarise(
        sold_by_nation(t), "n_name", {"lines": "l_linenumber"},
        {"average_quantity": "l_quantity", "average_discount": "l_discount"}, "sold",
    )


@query(
    "a3_ratio_means",
    """SELECT l_returnflag, count(*) AS videos_count, round(avg(l_quantity), 6) AS avg_view_count, round(avg(l_discount), 6) AS avg_likes_count,
       round(avg(l_discount / l_quantity), 6) AS avg_likes_per_view FROM lineitem GROUP BY l_returnflag""",
)
def _(t):
    names = ("videos_count", "avg_view_count", "avg_likes_count", "avg_likes_per_view")
    df = stats.ratio_means(t.lineitem, "l_returnflag", "l_discount", "l_quantity", names)
    return df.select("l_returnflag", names[0], *[F.round(n, 6).alias(n) for n in names[1:]])


@query(
    "a4_pivot",
    """SELECT n_name, nullif(count(*) FILTER (WHERE o_orderstatus = 'F'), 0) AS finished,
       nullif(count(*) FILTER (WHERE o_orderstatus = 'O'), 0) AS open,
       count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS both
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _(t):
    nations = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    df = t.orders.join(nations, F.col("o_custkey") == F.col("c_custkey"))
    return stats.pivot_counts(df, "n_name", "o_orderstatus", {"F": "finished", "O": "open"}, "both")


TYPE_COUNTS = """WITH counts AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL),
    scoped AS (SELECT lang, source, n FROM counts UNION ALL SELECT 'ALL', source, sum(n)::BIGINT FROM counts GROUP BY source)"""


@query(
    "a5_shares",
    f"""{TYPE_COUNTS} SELECT lang, source, n, round(n / (sum(n) OVER (PARTITION BY lang)), 9) AS share
        FROM scoped WHERE lang <> 'ALL'""",
)
def _(t):
    counts = t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))
    return stats.share_per_scope(counts, "lang", "source", "n", "share", grand_total=None).withColumn("share", F.round("share", 9))


@query(
    "a6_shares_with_total",
    f"{TYPE_COUNTS} SELECT lang, source, n, round(n / (sum(n) OVER (PARTITION BY lang)), 9) AS share FROM scoped",
)
def _(t):
    counts = t.documents.groupBy("lang", "source").agg(F.count("*").alias("n"))
    return stats.share_per_scope(counts, "lang", "source", "n", "share").withColumn("share", F.round("share", 9))


@query(
    "n6_share_of_total",
    "SELECT event_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM events), 9) AS share FROM events GROUP BY event_type",
)
def _(t):
    counts = t.events.withColumn("scope", F.lit("ALL")).groupBy("scope", "event_type").agg(F.count("*").alias("n"))
    shares = stats.share_per_scope(counts, "scope", "event_type", "n", "share", grand_total=None)
    return shares.select("event_type", "n", F.round("share", 9).alias("share"))


@query(
    "j8_group_total",
    """SELECT o_custkey, o_orderstatus, n, (sum(n) OVER (PARTITION BY o_custkey))::BIGINT AS per_customer
       FROM (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)""",
)
def _(t):
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    return stats.with_group_total(counts, "o_custkey", "n", "per_customer")


@query(
    "a7_per_month",
    "SELECT o_orderstatus, date_trunc('month', o_orderdate) AS month, count(*) AS count_per_month FROM orders GROUP BY ALL",
)
def _(t):
    return stats.aggregate_category_distribution_over_time_periods(t.orders, "o_orderstatus", "o_orderdate", "month")


@query(
    "a7_per_day",
    "SELECT event_type, date_trunc('day', ts) AS day, count(*) AS count_per_day FROM events GROUP BY ALL",
)
def _(t):
    return stats.aggregate_category_distribution_over_time_periods(t.events, ["event_type"], "ts", "day")


@query(
    "a8_column_maxima",
    """SELECT l_partkey, max(l_shipdate) AS latest, max(l_extendedprice) AS views, max(l_quantity) AS likes
       FROM lineitem GROUP BY l_partkey""",
)
def _(t):
    return stats.column_wise_max(
        t.lineitem, "l_partkey", {"l_shipdate": "latest", "l_extendedprice": "views", "l_quantity": "likes"}
    )


WORD_FLAGS = """WITH words AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part),
    top AS (SELECT word FROM words GROUP BY word ORDER BY count(*) DESC, word LIMIT 5),
    flagged AS (SELECT p_partkey, CASE WHEN word IN (FROM top) THEN 1 ELSE 0 END AS top_word FROM words),
    per_part AS (SELECT p_partkey, count(*) AS tags_count, sum(top_word)::BIGINT AS top_word_count, max(top_word) AS has_top_word
        FROM flagged GROUP BY p_partkey)"""


def word_flags(t):
    words = reshape.explode_string_column(t.part.select("p_partkey", "p_name"), "p_name", " ", "word")
    counts = stats.group_by_count(words, "word")
    top = ranking.top_n(counts, [F.col("word_count").desc(), F.col("word")], 5)
    return stats.flag_summary(flag_members(words, "word", top, "top_word"), "p_partkey", "top_word")


@query("a9_flag_summary", f"{WORD_FLAGS} FROM per_part")
def _(t):
    return word_flags(t)


@query(
    "a10_coverage",
    f"""{WORD_FLAGS} SELECT (SELECT count(*) FROM part) AS total_videos, sum(tags_count) / (SELECT count(*) FROM part) AS average_tags_per_video,
        (SELECT count(nullif(p_name, 'red rod')) / count(*) FROM part) AS share_with_tags,
        sum(top_word_count) / (SELECT count(*) FROM part) AS average_top_words_per_video,
        sum(has_top_word) / (SELECT count(*) FROM part) AS share_with_top_word FROM per_part""",
)
def _(t):
    videos = t.part.select(F.nullif("p_name", F.lit("red rod")).alias("p_name"))
    return stats.tag_coverage(word_flags(t), videos, "p_name", "top_word")


@query(
    "a11_histogram",
    "SELECT orders, count(*) AS count FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey) GROUP BY orders",
)
def _(t):
    return stats.histogram(t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders")), "orders")


@query("a13_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def _(t):
    return dedup.distinct_rows(t.part.select("p_brand", "p_type"))


FIRST_EVENT = "SELECT event_id, user_id, event_type, ts FROM events QUALIFY row_number() OVER"


@query("a14_one_per_key", "SELECT p_partkey, p_name, p_type FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_type ORDER BY p_partkey) = 1")
def _(t):
    df = t.part.select("p_partkey", "p_name", "p_type")
    return dedup.drop_duplicates_by_ordered_partition(df, ["p_name", "p_type"], "p_partkey")


@query("a15_lookup_pairs", "SELECT p_name, min(p_brand) AS p_brand FROM (SELECT p_name, nullif(p_brand, 'Brand#1') AS p_brand FROM part) WHERE p_brand IS NOT NULL GROUP BY p_name")
def _(t):
    df = t.part.select("p_name", F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"))
    return dedup.key_value_lookup(df, "p_name", "p_brand")


@query("n1_first_in_order", f"{FIRST_EVENT} (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) = 1")
def _(t):
    df = dedup.drop_duplicates_by_ordered_partition(t.events, ["user_id", "event_type"], [F.col("value").desc(), "event_id"])
    return df.select("event_id", "user_id", "event_type", "ts")


@query("n2_latest", f"{FIRST_EVENT} (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def _(t):
    return dedup.latest_per_key(t.events, "user_id", "ts", ["event_id"]).select("event_id", "user_id", "event_type", "ts")


@query("n3_earliest", f"{FIRST_EVENT} (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def _(t):
    return dedup.earliest_per_key(t.events, "user_id", "ts", ["event_id"]).select("event_id", "user_id", "event_type", "ts")


@query(
    "n4_top_k",
    f"""SELECT n_name, p_type, n, rank FROM (SELECT n_name, p_type, n, CAST(row_number() OVER (PARTITION BY n_name ORDER BY n DESC, p_type) AS INTEGER) AS rank
        FROM (SELECT n_name, p_type, count(*) AS n FROM {SOLD} JOIN part ON l_partkey = p_partkey GROUP BY ALL)) WHERE rank <= 3""",
)
def _(t):
    counts = (
        sold_by_nation(t).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("n_name", "p_type").agg(F.count("*").alias("n"))
    )
    return ranking.top_k_per_group(counts, "n_name", [F.col("n").desc(), F.col("p_type")], 3)


@query("n5_dense_ids", "SELECT text, dense_rank() OVER (ORDER BY text) AS tag_id FROM (SELECT DISTINCT text FROM documents)")
def _(t):
    return ranking.dense_ids(t.documents, "text", "tag_id")


@query("n7_ids_without_collision", "SELECT count(DISTINCT c_name) AS names, count(DISTINCT c_name) AS ids, CAST(0 AS BIGINT) AS shared FROM customer")
def _(t):
    dimension = dims.create_unique_df(t.customer, "c_name", "name", "id")
    per_id = dimension.groupBy("id").agg(F.count("*").alias("n"))
    return per_id.agg(
        F.sum("n").alias("names"), F.count("*").alias("ids"), F.count_if(F.col("n") > 1).alias("shared")
    )


@query("n10_batches", "SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 500) AS BIGINT) AS batch_id FROM orders")
def _(t):
    return ranking.assign_batches(t.orders, "o_orderkey", 500)


@query(
    "e2_request_groups",
    """SELECT batch_id, string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) AS ids FROM (SELECT c_custkey,
       CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 50) AS BIGINT) AS batch_id FROM customer) GROUP BY batch_id""",
)
def _(t):
    groups = ranking.request_groups(t.customer, "c_custkey", 50)
    return groups.select("batch_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


@query(
    "u1_stacked",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment, NULL::DOUBLE AS s_acctbal FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment")
    b = t.supplier.select("s_acctbal", F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return reshape.stack(a, b)


@query("u2_stacked_strictly", "SELECT c_custkey AS id, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return reshape.stack(a, b, allow_missing=False)


@query(
    "u3_corrected_rows",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, -o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    corrected = df.where("o_orderstatus = 'P'").withColumn("o_totalprice", -F.col("o_totalprice"))
    return reshape.stack(df.where("o_orderstatus <> 'P'"), corrected, allow_missing=False).drop("o_orderstatus")


@query(
    "u4_not_found",
    """SELECT o_custkey AS id, max(o_totalprice) AS price, 1 AS is_scraped FROM orders GROUP BY o_custkey
       UNION ALL SELECT c_custkey, NULL, -1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def _(t):
    answered = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_totalprice").alias("price"))
    requested = t.customer.select(F.col("c_custkey").alias("id"))
    return reshape.add_not_found_rows(answered.withColumn("is_scraped", F.lit(1)), requested, "id")


@query("u5_exploded_text", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def _(t):
    return reshape.explode_string_column(t.part.select("p_partkey", "p_name"), "p_name", " ", "word")


@query("u5_exploded_in_place", "SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents")
def _(t):
    return reshape.explode_string_column(t.documents.select("doc_id", "text"), "text", "\n")


@query("u6_exploded_array", "SELECT DISTINCT lower(word) AS tag, p_type FROM (SELECT p_type, unnest(string_split(upper(p_name), ' ')) AS word FROM part)")
def _(t):
    df = ensure_list_column(t.part.select("p_type", F.upper("p_name").alias("p_name")), "p_name", " ")
    return reshape.explode_array(df, "p_name", "tag", lower=True).distinct()


@query(
    "u7_exploded_map",
    """SELECT DISTINCT p_partkey, unnest(['blocked', 'allowed']) AS restriction_type, unnest([p_brand, p_type]) AS country_code FROM part
       UNION SELECT p_partkey, 'blocked', p_name FROM part""",
)
def _(t):
    restriction = F.create_map(F.lit("blocked"), F.array("p_brand", "p_name", "p_brand"), F.lit("allowed"), F.array("p_type"))
    df = t.part.select("p_partkey", restriction.alias("region_restriction"))
    return reshape.explode_map_of_lists(df, "region_restriction", "restriction_type", "country_code", ["p_partkey"])


@query(
    "u8_moved_values",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return reshape.move_values_between_columns(df, F.col("o_orderstatus") == "P", "o_orderstatus", "o_orderpriority")
