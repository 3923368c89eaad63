"""Joins, upserts, title matching, dimensions and bridges."""

from pyspark.sql import functions as F

from reelsift.operators import dims, joins, match, stats
from reelsift.operators.dedup import distinct_rows, drop_duplicates_by_ordered_partition
from reelsift.plans import stars
from reelsift.session import durable
from reelsift.sources import writers
from reelsift.sources.keytable import KeyTable, nth_hash
from workload.registry import query


@query(
    "j1_inner",
    """SELECT r_name, count(*) AS suppliers, round(sum(s_acctbal), 2) AS balance FROM supplier
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
def _(t):
    nations = joins.dimension_lookup(
        t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, "r_regionkey", ["r_name"], "inner"
    ).withColumnRenamed("n_nationkey", "s_nationkey")
    located = joins.dimension_lookup(t.supplier, nations, "s_nationkey", ["r_name"], "inner")
    return located.groupBy("r_name").agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))


@query("j2_left_using", "SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def _(t):
    return joins.dimension_lookup(t.documents.select("doc_id", "lang"), t.labels, "doc_id", ["quality", "toxic"])


@query("j3_left_differing_names", "SELECT p_partkey, p_name, c_name FROM part LEFT JOIN customer ON p_size = c_custkey AND c_nationkey < 10")
def _(t):
    customers = t.customer.where("c_nationkey < 10").withColumnRenamed("c_custkey", "p_size")
    return joins.dimension_lookup(t.part, customers, "p_size", ["c_name"]).select("p_partkey", "p_name", "c_name")


@query(
    "j4_choosing_sides",
    """SELECT l.l_orderkey, l.l_quantity, r.n FROM lineitem l JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) r
       ON l.l_orderkey = r.l_orderkey""",
)
def _(t):
    counts = stats.group_by_count(t.lineitem, "l_orderkey").withColumnRenamed("l_orderkey_count", "n")
    return joins.dimension_lookup(t.lineitem.select("l_orderkey", "l_quantity"), counts, "l_orderkey", ["n"], "inner")


def finished_orders(t):
    """Finished orders at a changed price."""
    return t.orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.round(F.col("o_totalprice") + 1, 2))


REPLACED = """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice + 1, 2)
    ELSE o_totalprice END AS o_totalprice FROM orders"""


@query("j5_replaced_rows", REPLACED)
def _(t):
    replaced = joins.replace_rows(t.orders, finished_orders(t), "o_orderkey")
    return replaced.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(
    "e7_batch_replaced",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer",
)
def _(t):
    batch = t.customer.where("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.lit(0.0))
    return joins.replace_rows(t.customer, batch, "c_custkey").select("c_custkey", "c_acctbal")


@query("j6_mapped_key", "SELECT s_suppkey, r_name AS s_nationkey FROM supplier LEFT JOIN region ON s_nationkey = r_regionkey")
def _(t):
    mapping = t.region.select(F.col("r_regionkey").alias("s_nationkey"), "r_name")
    return joins.map_column(t.supplier.select("s_suppkey", "s_nationkey"), mapping, "r_name", "s_nationkey")


@query("j7_overridden", "SELECT c_custkey, coalesce(s_name, c_name) AS c_name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey AND s_acctbal > 0")
def _(t):
    corrections = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("c_custkey"), "s_name")
    return joins.override_column(t.customer.select("c_custkey", "c_name"), corrections, "c_custkey", "c_name", "s_name")


@query(
    "j12_derived_dimension",
    """SELECT DISTINCT p_brand, g.word FROM part JOIN (SELECT DISTINCT p_name, split_part(p_name, ' ', 2) AS word FROM part) g
       ON part.p_name = g.p_name""",
)
def _(t):
    words = distinct_rows(t.part.select("p_name", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word")))
    return distinct_rows(joins.dimension_lookup(t.part, words, "p_name", ["word"], "inner").select("p_brand", "word"))


@query(
    "s13_upserted",
    """WITH updates AS (SELECT o_orderkey + 7000 AS o_orderkey, o_custkey, o_totalprice, DATE '2024-05-06' AS last_updated_date
            FROM orders WHERE o_orderpriority = '1-URGENT')
       SELECT o_orderkey, o_custkey, o_totalprice, DATE '2000-01-01' AS last_updated_date FROM orders
            WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates) UNION ALL FROM updates""",
)
def _(t):
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "last_updated_date"]
    target = t.orders.withColumn("last_updated_date", F.lit("2000-01-01").cast("date")).select(*columns)
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", F.col("o_orderkey") + 7000)
    updates = urgent.withColumn("last_updated_date", F.lit(None).cast("date")).select(*columns)
    return writers.upsert(target, updates.union(updates), "o_orderkey", "2024-05-06")


PAGE_TITLES = "SELECT page_id, rtrim(regexp_extract(html, '<title>([^<]*)</title>', 1), '.') AS title FROM pages"
# A word is letters, digits and underscores of any script; a title starting or ending with
# something else must touch a word there.
WHOLE_WORD = r"""regexp_matches(lower({text}),
    CASE WHEN regexp_matches({title}, '^[\p{{L}}\p{{N}}_]') THEN '(^|[^\p{{L}}\p{{N}}_])' ELSE '[\p{{L}}\p{{N}}_]' END
    || regexp_escape(lower({title})) ||
    CASE WHEN regexp_matches({title}, '[\p{{L}}\p{{N}}_]$') THEN '($|[^\p{{L}}\p{{N}}_])' ELSE '[\p{{L}}\p{{N}}_]' END)"""


def page_titles(t):
    title = F.rtrim(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("."))
    return t.pages.select("page_id", title.alias("title"))


@query(
    "j9_title_in_text",
    f"""WITH t AS ({PAGE_TITLES}), near AS MATERIALIZED (SELECT page_id, title, doc_id, text FROM t JOIN documents
            ON length(title) >= 6 AND contains(lower(text), lower(title)))
        SELECT page_id, doc_id FROM near WHERE {WHOLE_WORD.format(text='text', title='title')}""",
)
def _(t):
    texts = t.documents.select("doc_id", "text")
    return match.match_titles(page_titles(t), texts, "title", "text", "doc_id").select("page_id", "doc_id")


@query(
    "j9_passage_in_text",
    f"""WITH near AS MATERIALIZED (SELECT item_id, doc_id, rtrim(b.text, '.') AS title, d.text FROM benchmark b
            JOIN documents d ON contains(lower(d.text), lower(rtrim(b.text, '.'))))
        SELECT item_id, doc_id FROM near WHERE {WHOLE_WORD.format(text='text', title='title')}""",
)
def _(t):
    passages = t.benchmark.select("item_id", F.rtrim("text", F.lit(".")).alias("passage"))
    texts = t.documents.select("doc_id", "text")
    return match.match_titles(passages, texts, "passage", "text", "doc_id").select("item_id", "doc_id")


@query(
    "j10_whole_words",
    f"""SELECT page_id, contains(lower(html), lower(title)) AND {WHOLE_WORD.format(text='html', title='title')} AS found
        FROM (SELECT page_id, html, split_part(regexp_extract(html, '<title>([^<]*)</title>', 1), ' ', 1) || ' ' || 'the' AS title FROM pages)""",
)
def _(t):
    first = F.split_part(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(" "), F.lit(1))
    return t.pages.select("page_id", match.exact_match(F.col("html"), F.concat(first, F.lit(" the"))).alias("found"))


@query(
    "j11_best_with_ties",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC) = 1",
)
def _(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    return match.best_per_key(df, "o_custkey", "year").drop("year")


@query(
    "j11_best_one",
    "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) = 1",
)
def _(t):
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year"))
    return match.best_per_key(df, "o_custkey", "year", ties="one", tie_breakers=["o_orderkey"]).drop("year")


LISTS = "(SELECT p_partkey, replace(p_name, ' ', ', ') || ', ' || p_type AS cast_list FROM part)"
WORD_DIMENSION = f"""WITH pairs AS (SELECT p_partkey, trim(unnest(string_split(cast_list, ','))) AS actor_name FROM {LISTS}),
    dimension AS (SELECT actor_name, dense_rank() OVER (ORDER BY actor_name) AS actor_id FROM (SELECT DISTINCT actor_name FROM pairs))"""


def cast_lists(t):
    return t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", "), "p_type").alias("cast_list"))


@query("d1_dimension", f"{WORD_DIMENSION} FROM dimension")
def _(t):
    return dims.create_unique_df(cast_lists(t), "cast_list", "actor_name", "actor_id", ids="dense")


@query("d2_bridge", f"{WORD_DIMENSION} SELECT p_partkey, actor_id FROM pairs JOIN dimension USING (actor_name)")
def _(t):
    lists = cast_lists(t)
    dimension = dims.create_unique_df(lists, "cast_list", "actor_name", "actor_id", ids="dense")
    return dims.create_association_table(lists, dimension, "cast_list", "actor_name", "p_partkey", "actor_id")


# The parts come in three slices by their key; each brings names the earlier ones had, and new ones.
SLICED = f"""WITH pairs AS (SELECT p_partkey, p_partkey % 3 AS slice, trim(unnest(string_split(cast_list, ','))) AS actor_name FROM {LISTS}),
    dimension AS (SELECT actor_name, row_number() OVER (ORDER BY min(slice), actor_name) AS actor_id FROM pairs GROUP BY actor_name)"""


def keyed_slices(t):
    """The key table, and the dimension and bridge of every slice."""
    keys = KeyTable(t.spark, f"{t.database()}.actors", base_path=t.scratch(), parts=4)
    lists = cast_lists(t)
    return keys, [
        dims.keyed_dimension_and_bridge(lists.where(F.col("p_partkey") % 3 == k), keys, "cast_list", "actor_name", "p_partkey", "actor_id") for k in range(3)
    ]


@query("d1_dimension_by_slices", f"{SLICED} SELECT actor_name, actor_id, slice FROM dimension JOIN (SELECT DISTINCT actor_name, slice FROM pairs) USING (actor_name)")
def _(t):
    _, slices = keyed_slices(t)
    told = [dimension.withColumn("slice", F.lit(k).cast("bigint")) for k, (dimension, _) in enumerate(slices)]
    return told[0].unionByName(told[1]).unionByName(told[2])


@query("d2_bridge_by_slices", f"{SLICED} SELECT p_partkey, actor_id FROM pairs JOIN dimension USING (actor_name)")
def _(t):
    _, slices = keyed_slices(t)
    return slices[0][1].unionByName(slices[1][1]).unionByName(slices[2][1])


@query(
    "n7_persistent_ids",
    """SELECT count(DISTINCT c_name) AS names, count(DISTINCT c_name) AS ids, CAST(0 AS BIGINT) AS changed, true AS some_met,
       (SELECT count(*) FROM customer) AS looked_up FROM customer""",
)
def _(t):
    # A first hash of few values, so that many meet, and a second one of more.
    weak = lambda value, attempt: F.pmod(nth_hash(value, attempt), F.lit(1000 * 100**attempt))
    keys = KeyTable(t.spark, f"{t.database()}.names", "hashed", base_path=t.scratch(), hashes=weak)
    before = durable(keys.extend(t.customer.where("c_custkey % 2 = 0"), "c_name"))
    keys.extend(t.customer, "c_name")
    after = keys.rows()
    changed = before.join(after.select("value", F.col("id").alias("now")), "value").where("id != now")
    counts = after.agg(F.count("*").alias("names"), F.count_distinct("id").alias("ids"), F.max(F.col("attempt") > 0).alias("some_met"))
    found = keys.with_ids(t.customer, "c_name", "found").join(after, (F.col("c_name") == F.col("value")) & (F.col("found") == F.col("id")))
    # One row by one row.
    return counts.crossJoin(changed.agg(F.count("*").alias("changed"))).crossJoin(found.agg(F.count("*").alias("looked_up")))


@query("d2_bridge_by_hash", f"{WORD_DIMENSION} SELECT p_partkey, actor_name FROM pairs")
def _(t):
    lists = cast_lists(t)
    dimension = dims.create_unique_df(lists, "cast_list", "actor_name", "actor_id")
    bridge = dims.create_association_table(lists, None, "cast_list", "actor_name", "p_partkey", "actor_id")
    return bridge.join(dimension, "actor_id").select("p_partkey", "actor_name")


# Eight list columns of a catalogue: empty names, blanks, repeats, nulls and an empty list among them.
CATALOGUE_LISTS = {
    "directors": "replace(p_name, ' ', ', ')", "actors": "p_name || ', ' || p_type || ' ,  ' || p_type", "countries": "p_brand", "genres": "replace(p_name, ' ', ',') || ',,'",
    "prod_companies": "CASE WHEN p_size % 3 > 0 THEN 'A, ' || p_brand END", "writers": "CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END", "languages": "' en,  ' || lower(p_type)",
    "platforms": "p_type",
}
ENTITY_PARTS = " UNION ALL ".join(
    f"SELECT '{entity}' AS entity, p_partkey AS show_id, trim(unnest(string_split({lists}, ','))) AS name FROM part" for entity, lists in CATALOGUE_LISTS.items()
)


def catalogue(t):
    """Parts as a cleaned catalogue, with its 19 fact columns and eight list columns."""
    columns = {stars.CATALOGUE_ENTITIES[entity][0]: F.expr(lists) for entity, lists in CATALOGUE_LISTS.items()}
    facts = {c: F.lit(None).cast("string") for c in stars.SHOW_COLUMNS} | {
        "show_id": F.col("p_partkey"), "title": F.col("p_name"), "rating": F.col("p_size") / 5, "budget_eur": F.col("p_retailprice"), "duration_minutes": F.col("p_size"),
    }
    return t.part.select(*[column.alias(name) for name, column in (facts | columns).items()])


def one_table(frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query("d1_catalogue_entities", f"SELECT DISTINCT entity, name FROM ({ENTITY_PARTS}) WHERE name <> ''")
def _(t):
    tables = stars.catalogue_entities(catalogue(t))
    names = {entity: name for entity, (_, name, _) in stars.CATALOGUE_ENTITIES.items()}
    return one_table([tables[entity].select(F.lit(entity).alias("entity"), F.col(name).alias("name")) for entity, name in names.items()])


@query("d2_catalogue_bridges", f"SELECT entity, show_id, name FROM ({ENTITY_PARTS}) WHERE name <> ''")
def _(t):
    tables = stars.catalogue_entities(catalogue(t))
    bridges = []
    for entity, (_, name, id_name) in stars.CATALOGUE_ENTITIES.items():
        # The files are small for the pairs in them: by their size alone the pairs would be sent to every task.
        named = tables[f"shows_and_movies_{entity}"].hint("merge").join(tables[entity], id_name)
        bridges.append(named.select(F.lit(entity).alias("entity"), "show_id", F.col(name).alias("name")))
    return one_table(bridges)


@query(
    "d1_catalogue_facts",
    """SELECT p_partkey AS show_id, p_name AS title, p_size / 5 AS rating, p_retailprice AS budget_eur, p_size AS duration_minutes, """
    + ", ".join(f"NULL::VARCHAR AS {c}" for c in stars.SHOW_COLUMNS if c not in ("show_id", "title", "rating", "budget_eur", "duration_minutes"))
    + " FROM part",
)
def _(t):
    return stars.catalogue_entities(catalogue(t))["shows_and_movies"]


@query("d4_channels", "SELECT p_brand AS channel_id, min(p_name) AS channel_title FROM part GROUP BY p_brand")
def _(t):
    return stars.channel_dimension(t.part.select(F.col("p_brand").alias("channel_id"), F.col("p_name").alias("channel_title")))


@query(
    "d5_region_restrictions",
    """SELECT DISTINCT l_partkey AS video_id, CASE WHEN l_returnflag = 'R' THEN 'blocked' ELSE 'allowed' END AS restriction_type,
       n_name AS country_code FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
)
def _(t):
    sold = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    kind = F.when(F.col("l_returnflag") == "R", "blocked").otherwise("allowed")
    lists = sold.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("l_partkey").alias("video_id"), F.create_map(kind, F.array("n_name")).alias("region_restriction")
    )
    return stars.region_restrictions(lists)
