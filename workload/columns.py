"""Renames, casts, text, value and date rules."""

from pyspark.sql import functions as F

from reelsift.functions import dates, money, text, values
from reelsift.operators import schema
from workload.registry import query


@query("p1_renamed", "SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return schema.rename_columns(t.customer, {"c_custkey": "id", "c_name": "name"})


@query(
    "p2_prefixed",
    "SELECT s_suppkey AS new_s_suppkey, s_name AS new_s_name, s_nationkey AS new_s_nationkey, s_acctbal AS new_s_acctbal FROM supplier",
)
def _(t):
    return schema.add_prefix_to_column_names(t.supplier, "new_")


@query("p3_ensured", "SELECT c_custkey, c_acctbal, CAST(0 AS INTEGER) AS is_scraped FROM customer")
def _(t):
    df = t.customer.select("c_custkey", "c_acctbal")
    return schema.ensure_column_existence(schema.ensure_column_existence(df, "is_scraped", "int", 0), "c_acctbal", "int", 0)


@query("p4_merged_schema", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS duration, CAST(NULL AS BIGINT) AS views FROM customer")
def _(t):
    return schema.merge_schema_into_dataframe(
        t.customer.select("c_custkey", "c_name"), "c_name string, duration string, views bigint"
    )


@query("p5_null_columns", "SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS rating, CAST(NULL AS VARCHAR) AS votes FROM supplier")
def _(t):
    return schema.add_null_columns(t.supplier.select("s_suppkey", "s_name"), ["rating", "s_name", "votes"])


@query(
    "p6_coalesced",
    """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), c_name) AS c_name,
       coalesce(CASE WHEN c_acctbal > 5000 THEN c_acctbal END, -1.0) AS c_acctbal FROM customer""",
)
def _(t):
    df = t.customer.select(
        "c_custkey",
        "c_name",
        F.lit(-1.0).alias("c_acctbal"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("new_c_name"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_acctbal")).alias("new_c_acctbal"),
    )
    return schema.coalesce_prefixed_columns(df, "new_", ["c_name", "c_acctbal"])


@query(
    "p7_listed",
    """SELECT p_partkey, len(string_split(nullif(p_name, 'red rod'), ' ')) AS words,
       string_split(nullif(p_name, 'red rod'), ' ')[1] AS first_word FROM part""",
)
def _(t):
    df = schema.ensure_list_column(t.part, "p_name", " ", "red rod")
    df = schema.ensure_list_column(df, "p_name", " ")
    words = F.when(F.col("p_name").isNotNull(), F.size("p_name").cast("bigint"))
    return df.select("p_partkey", words.alias("words"), F.get("p_name", F.lit(0)).alias("first_word"))


@query("p8_flags_as_int", "SELECT c_custkey, CAST(c_acctbal > 0 AS INTEGER) AS positive, CAST(c_nationkey = 3 AS INTEGER) AS third FROM customer")
def _(t):
    df = t.customer.select("c_custkey", (F.col("c_acctbal") > 0).alias("positive"), (F.col("c_nationkey") == 3).alias("third"))
    return schema.convert_bool_columns_to_int(df)


@query(
    "p9_cast",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS release_date, CAST(o_custkey AS VARCHAR) AS o_custkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders",
)
def _(t):
    df = t.orders.withColumnRenamed("o_orderdate", "release_date").drop("o_orderstatus", "o_totalprice")
    return schema.cast_columns(df, {"release_date": "date", "o_custkey": "string", "o_orderpriority": "int"})


@query("p10_constants", "SELECT s_suppkey, 'Disney' AS platform, 'No' AS is_scraped FROM supplier")
def _(t):
    df = schema.add_platform_column(t.supplier.select("s_suppkey"), "dsny")
    return df.withColumn("is_scraped", F.lit("No"))


@query("p11_projected", "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem")
def _(t):
    return schema.project(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"])


@query(
    "f1_outer_quotes",
    "SELECT p_partkey, trim(repeat(chr(34), 2) || p_name || chr(34) || p_type || repeat(chr(34), 3), chr(34)) AS bare FROM part",
)
def _(t):
    quoted = F.concat(F.lit('""'), "p_name", F.lit('"'), "p_type", F.lit('"""'))
    return t.part.select("p_partkey", text.remove_outer_quotes(quoted).alias("bare"))


@query(
    "f2_country_quotes",
    r"""SELECT n_nationkey, regexp_replace(regexp_replace(' "' || n_name || '""  ', '^\s*"', ''), '"\s*$', '') AS countries FROM nation""",
)
def _(t):
    df = t.nation.select("n_nationkey", F.concat(F.lit(' "'), "n_name", F.lit('""  ')).alias("countries"))
    return text.remove_quotes_from_country(df)


@query(
    "f3_leading_comma",
    r"SELECT p_partkey, regexp_replace(translate(p_name, 'r', ','), '^,\s+', '') AS cleaned FROM (SELECT p_partkey, replace(p_name, 'red ', 'r ') AS p_name FROM part)",
)
def _(t):
    shortened = F.translate(F.replace("p_name", F.lit("red "), F.lit("r ")), "r", ",")
    return t.part.select("p_partkey", text.strip_leading_comma(shortened).alias("cleaned"))


@query("f4_replaced", "SELECT p_partkey, regexp_replace(p_name, '^(red|hot) ', 'Big ', 'g') AS title FROM part")
def _(t):
    df = t.part.select("p_partkey", F.col("p_name").alias("title"))
    return text.replace_unwanted_string_in_column(df, "^(red|hot) ", "Big ")


@query("f5_id_prefix", "SELECT c_custkey, regexp_replace(lower(c_name), '^customer#', 'nflx') AS show_id FROM customer")
def _(t):
    df = t.customer.select("c_custkey", F.lower("c_name").alias("show_id"))
    return text.change_id_prefix(df, "nflx", old="customer#")


@query("f6_truncated", "SELECT p_partkey, substr(p_name, 1, 5) AS p_name, substr(p_brand, 1, 5) AS p_brand, substr(p_type, 3) AS p_type FROM part")
def _(t):
    df = text.truncate_string_columns(t.part.select("p_partkey", "p_name", "p_brand", "p_type"), ["p_name", "p_brand"], 1, 5)
    return text.truncate_string_columns(df, "p_type", 3)


@query(
    "f7_replaced_value",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       coalesce(nullif(o_orderpriority, '5-LOW'), '?') AS o_orderpriority FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    df = values.replace_value_in_column(df, "o_orderpriority", None, "?")
    return values.replace_value_in_column(df, "o_orderstatus", "P", None)


SEGMENTS = {"AUTOMOBILE": "A", "BUILDING": "B", "MACHINERY": None}


@query(
    "f8_mapped",
    """SELECT c_custkey, c_mktsegment, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B' ELSE 'other' END AS code,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B' END AS strict FROM customer""",
)
def _(t):
    df = values.map_column_values(t.customer.select("c_custkey", "c_mktsegment"), SEGMENTS, "c_mktsegment", "code", "other")
    return values.map_column_values(df, SEGMENTS, "c_mktsegment", "strict")


@query("f8_large_mapping", "SELECT o_orderkey, CASE WHEN o_custkey < 150 THEN o_custkey * 2 ELSE -1 END AS doubled FROM orders")
def _(t):
    return values.map_column_values(
        t.orders.select("o_orderkey", "o_custkey"), {i: i * 2 for i in range(150)}, "o_custkey", "doubled", -1
    ).drop("o_custkey")


@query(
    "f8_mapping_sizes",
    """SELECT o_orderkey, CASE WHEN o_custkey < 100 THEN o_custkey * 2 ELSE -1 END AS at_limit, CASE WHEN o_custkey < 101 THEN o_custkey * 2 ELSE -1 END AS beyond FROM orders""",
)
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey")
    for size, name in ((100, "at_limit"), (101, "beyond")):
        df = values.map_column_values(df, {i: i * 2 for i in range(size)}, "o_custkey", name, -1)
    return df.drop("o_custkey")


@query(
    "f9_text_flags",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS caption FROM lineitem""",
)
def _(t):
    text_flag = F.when(F.col("l_returnflag") == "A", "TRUE").when(F.col("l_returnflag") == "N", "False").otherwise("x")
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", text_flag.alias("caption"))
    return values.convert_string_boolean_to_int(df, "caption")


@query("f10_long_dates", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date_added FROM orders")
def _(t):
    written = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "MMMM d, yyyy")).otherwise("soon")
    return dates.convert_date_format(t.orders.select("o_orderkey", written.alias("date_added")), "date_added")


@query(
    "f11_release_dates",
    """SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN CAST(o_orderdate AS DATE)
       WHEN '2' THEN CAST(date_trunc('year', o_orderdate) AS DATE) WHEN '3' THEN CAST(o_orderdate AS DATE)
       WHEN '4' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS release_date FROM orders""",
)
def _(t):
    kind = F.substring("o_orderpriority", 1, 1)
    written = (
        F.when(kind == "1", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(kind == "2", F.date_format("o_orderdate", "yyyy"))
        .when(kind == "3", F.concat(F.date_format("o_orderdate", "dd MMM yyyy"), F.lit(" (USA)")))
        .when(kind == "4", F.date_format("o_orderdate", "MMM yyyy"))
        .otherwise("unknown")
    )
    return t.orders.select("o_orderkey", dates.release_date(written).alias("release_date"))


@query(
    "f12_durations",
    r"""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN NULL ELSE
        (CASE WHEN l_linestatus = 'F' THEN l_linenumber::VARCHAR ELSE '0' END) || '.' || lpad((l_linenumber * 3)::VARCHAR, 2, '0')
        || ':' || lpad(CAST(l_quantity AS INTEGER)::VARCHAR, 2, '0') || ':00' END AS duration FROM lineitem""",
)
def _(t):
    days = F.when(F.col("l_linestatus") == "F", F.concat(F.col("l_linenumber").cast("string"), F.lit("D"))).otherwise("")
    clock = F.concat(
        F.lit("T"), (F.col("l_linenumber") * 3).cast("string"), F.lit("H"), F.col("l_quantity").cast("int").cast("string"), F.lit("M")
    )
    iso = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("P"), F.coalesce(days, F.lit("")))).otherwise(
        F.concat(F.lit("P"), days, clock)
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", dates.iso8601_to_time(iso).alias("duration"))


@query(
    "f13_local_times",
    """SELECT event_id, CASE event_type WHEN 'click' THEN (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'
       WHEN 'view' THEN (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Asia/Kolkata'
       WHEN 'error' THEN (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' ELSE ts END AS local_ts FROM events""",
)
def _(t):
    country = F.when(F.col("event_type") == "click", "US").when(F.col("event_type") == "view", "IN").when(
        F.col("event_type") == "error", "DE"
    ).otherwise("XX")
    df = dates.convert_to_local_time(t.events.withColumn("country", country), "ts", "country", "local_ts")
    return df.select("event_id", "local_ts")


@query(
    "f14_truncated_times",
    "SELECT event_id, date_trunc('month', ts) AS month, date_trunc('day', ts) AS day, date_trunc('year', ts) AS year FROM events",
)
def _(t):
    ev = t.events
    return ev.select("event_id", *[dates.truncate_time(ev, "ts", p).alias(p) for p in ("month", "day", "year")])


@query("f15_run_date", "SELECT s_suppkey, DATE '2024-05-06' AS last_updated_date FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", dates.run_date("2024-05-06").alias("last_updated_date"))


@query(
    "f16_duration_split",
    """SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_size END AS duration_minutes,
       CASE WHEN p_type = 'LARGE' THEN p_size END AS duration_seasons FROM part""",
)
def _(t):
    category = F.when(F.col("p_type") == "SMALL", "Movie").when(F.col("p_type") == "LARGE", "TV Show")
    df = t.part.select("p_partkey", category.alias("category"), F.concat(F.col("p_size").cast("string"), F.lit(" min")).alias("duration"))
    return dates.split_duration(df).drop("category")


@query(
    "f17_series_years",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS first_series_years,
       CASE o_orderstatus WHEN 'F' THEN CAST(year(o_orderdate) + 2 AS INTEGER) END AS last_series_years FROM orders""",
)
def _(t):
    first = F.year("o_orderdate")
    years = F.when(F.col("o_orderstatus") == "F", F.concat_ws("-", first, first + 2)).when(
        F.col("o_orderstatus") == "O", F.concat(first, F.lit("-"))
    ).otherwise(first.cast("string"))
    return dates.split_series_years(t.orders.select("o_orderkey", years.alias("series_years")))


def box_office(t):
    """Box-office texts written from the line items: currency by line number, parts left out by flag."""
    whole = F.format_number(F.floor("l_extendedprice"), 0)
    unit = F.element_at(F.array(*[F.lit(c) for c in ("$", "INR", "GBP", "XXX", "EUR", "€", "FRF")]), F.col("l_linenumber"))
    budget = F.when(F.col("l_returnflag") != "R", F.concat(F.lit("Budget="), unit, whole, F.lit(" (estimated), "))).otherwise("")
    opening = F.concat(F.lit("Opening Weekend United States="), unit, whole, F.lit(", 02 Jan 2020, "))
    gross = F.concat(F.lit("Cumulative Worldwide Gross="), unit, whole)
    written = F.concat(F.lit("{"), budget, opening, gross, F.lit("}"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", F.floor("l_extendedprice").alias("amount"), written.alias("box_office"))


UNIT = "['$', 'INR', 'GBP', 'XXX', 'EUR', '€', 'FRF'][l_linenumber]"
RATE = "CASE l_linenumber WHEN 1 THEN 1.1082 WHEN 2 THEN 92.8401 WHEN 3 THEN 0.8448 WHEN 5 THEN 1.0 WHEN 7 THEN 6.55957 END::DOUBLE"
WHOLE = "format('{:,}', CAST(floor(l_extendedprice) AS BIGINT))"


@query(
    "f18_box_office",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag <> 'R' THEN 'Budget=' || {UNIT} || {WHOLE} || ' (estimated)' END AS budget,
        'Opening Weekend United States=' || {UNIT} || {WHOLE} || ', 02 Jan 2020' AS opening_weekend,
        'Cumulative Worldwide Gross=' || {UNIT} || {WHOLE} AS cumulative_worldwide_gross FROM lineitem""",
)
def _(t):
    df = money.extract_box_office_data(box_office(t).withColumn("box_office", money.strip_braces("box_office")))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", *money.BOX_OFFICE_FIELDS)


@query(
    "f19_money_tokens",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linenumber = 6 THEN '' ELSE {UNIT} || floor(l_extendedprice)::BIGINT END AS budget,
        CASE WHEN l_linenumber = 6 THEN '' ELSE {UNIT} || floor(l_extendedprice)::BIGINT END AS opening_weekend FROM lineitem""",
)
def _(t):
    df = money.extract_box_office_data(box_office(t))
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", *[money.money_token(f, f).alias(f) for f in ("budget", "opening_weekend")]
    )


@query(
    "f20_currency_amount",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {UNIT} AS currency, floor(l_extendedprice) AS amount FROM lineitem",
)
def _(t):
    unit = F.element_at(F.array(*[F.lit(c) for c in ("$", "INR", "GBP", "XXX", "EUR", "€", "FRF")]), F.col("l_linenumber"))
    currency, amount = money.extract_currency_and_amount(F.concat(unit, F.floor("l_extendedprice").cast("string")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", currency.alias("currency"), amount.alias("amount"))


@query(
    "f21_euro",
    f"SELECT l_orderkey, l_linenumber, l_partkey, round(floor(l_extendedprice) / ({RATE}), 6) AS eur FROM lineitem",
)
def _(t):
    unit = F.element_at(F.array(*[F.lit(c) for c in ("$", "INR", "GBP", "XXX", "EUR", "€", "FRF")]), F.col("l_linenumber"))
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", unit.alias("unit"), F.floor("l_extendedprice").cast("double").alias("amount"))
    df = money.convert_to_eur(df, "unit", "amount", "eur", money.rates_table(t.spark))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", F.round("eur", 6).alias("eur"))


@query(
    "f22_rounded",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag <> 'R' THEN round(floor(l_extendedprice) / ({RATE}), 0) END AS budget_eur,
        round(floor(l_extendedprice) / ({RATE}), 0) AS opening_weekend_eur,
        round(floor(l_extendedprice) / ({RATE}), 0) AS cumulative_worldwide_gross_eur FROM lineitem""",
)
def _(t):
    # The euro sign is not part of an amount's currency, so such amounts have no unit and give null.
    return money.box_office_to_eur(box_office(t)).drop("amount", "l_returnflag")


@query("f23_ratio", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / nullif(l_discount, 0.0) AS likes_per_view FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", values.ratio("l_quantity", "l_discount").alias("likes_per_view"))


@query("f25_keyword_flags", "SELECT p_partkey, CASE WHEN contains(p_name, 'ring') OR contains(p_name, 'old') THEN 'yes' ELSE 'no' END AS is_animation FROM part")
def _(t):
    return t.part.select("p_partkey", text.keyword_flag("p_name", ["ring", "old"]).alias("is_animation"))


@query(
    "f26_names_text",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN p_name ELSE p_name || ', ' || p_brand END AS names,
       p_name || ', ' || p_type AS listed FROM part""",
)
def _(t):
    person = lambda name: F.struct(name.alias("name"), F.lit("x").alias("role"))
    brand = F.when(F.col("p_type") != "SMALL", F.col("p_brand"))
    people = F.when(F.col("p_type") == "PROMO", F.filter(F.array(person(F.col("p_name"))), lambda _: F.lit(False))).otherwise(
        F.array(person(F.col("p_name")), person(brand))
    )
    return t.part.select(
        "p_partkey",
        values.names_text(people).alias("names"),
        values.list_to_comma_separated_string(F.array("p_name", "p_type")).alias("listed"),
    )


@query("f27_popularity", "SELECT p_partkey, p_size / 100.0::DOUBLE AS popularity FROM part")
def _(t):
    return t.part.select("p_partkey", values.percent_to_unit("p_size").alias("popularity"))


@query(
    "f28_pitch_and_mode",
    """SELECT p_partkey, ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][p_size + 1] AS key,
       CASE p_size WHEN 0 THEN 'Minor' WHEN 1 THEN 'Major' END AS mode FROM part""",
)
def _(t):
    return t.part.select("p_partkey", values.pitch_name("p_size").alias("key"), values.mode_name("p_size").alias("mode"))


@query(
    "f29_truth_flags",
    """SELECT p_partkey, CASE WHEN split_part(p_name, ' ', 1) = 'red' THEN 'Yes' ELSE 'No' END AS color,
       CASE WHEN p_type = 'PROMO' THEN 'No' ELSE 'Yes' END AS top_250 FROM part""",
)
def _(t):
    colours = F.split(F.replace("p_name", F.lit("red"), F.lit("Color")), " ")
    return t.part.select(
        "p_partkey", values.is_colour(colours).alias("color"), values.is_present(F.nullif("p_type", F.lit("PROMO"))).alias("top_250")
    )


@query(
    "f30_filled",
    "SELECT p_partkey, coalesce(nullif(p_type, 'PROMO'), '[OTHERS]') AS p_type, coalesce(nullif(p_name, 'red rod'), '[OTHERS]') AS p_name FROM part",
)
def _(t):
    df = t.part.select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"), F.nullif("p_name", F.lit("red rod")).alias("p_name"))
    return values.fill_string_nulls(df)
