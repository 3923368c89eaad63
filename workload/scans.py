"""Sources, sinks and table definitions: each query writes a driver table and reads it back."""

from pyspark.sql import functions as F

from reelsift.functions.values import map_literal
from reelsift.operators import joins
from reelsift.operators.ranking import hashed_id
from reelsift.session import durable
from reelsift.sources import readers, writers
from workload.registry import query

CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@query(
    "s1_media_csv",
    """SELECT doc_id::VARCHAR AS video_id, md5(text) AS title, doc_id::VARCHAR AS channel_id FROM documents""",
)
def _(t):
    path = t.scratch()
    # Texts with quotes and line breaks, under the raw names.
    rows = t.documents.select(
        F.col("doc_id").cast("string").alias("video_id"), F.col("text").alias("title"), F.col("doc_id").alias("channelId")
    )
    writers.write_csv(rows, path)
    read = readers.read_media_csv(t.spark, path, "video_id string, title string, channelId string")
    return read.withColumn("title", F.md5("title"))


@query("s1_split_csv", "SELECT doc_id::VARCHAR AS video_id, md5(text) AS title, doc_id::VARCHAR AS channel_id FROM documents")
def _(t):
    path = t.scratch()
    rows = t.documents.select(F.col("doc_id").cast("string").alias("video_id"), F.col("text").alias("title"), F.col("doc_id").alias("channelId"))
    # A file per task of the scan, read in blocks of 256 KB.
    writers.write_csv(rows, path)
    read = readers.read_media_csv(t.spark, path, "video_id string, title string, channelId string", split=True, block_bytes=256 << 10)
    return read.withColumn("title", F.md5("title"))


@query("s2_inferred_csv", "SELECT c_custkey::INTEGER AS c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = t.scratch()
    writers.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    return readers.load_csv(t.spark, path)


@query("s3_tag_translations", "SELECT DISTINCT p_name AS original_tag, upper(p_name) AS translated_tag FROM part")
def _(t):
    path = t.scratch()
    names = t.part.select(
        F.col("p_name").alias("normalized_tag"), F.lit("x").alias("language"), F.upper("p_name").alias("english_translation")
    ).distinct()
    writers.write_csv(names, path)
    return readers.read_tag_translations(t.spark, path)


@query("s4_csv_sink", "SELECT p_partkey, p_name, p_type || '\"' AS quoted FROM part")
def _(t):
    path = t.scratch()
    writers.write_csv(t.part.select("p_partkey", "p_name", F.concat("p_type", F.lit('"')).alias("quoted")), path)
    schema = "p_partkey bigint, p_name string, quoted string"
    return t.spark.read.schema(schema).options(**readers.CSV_DIALECT).csv(path)


@query("s5_parquet_scan", "SELECT l_orderkey, l_quantity FROM lineitem")
def _(t):
    return readers.read_parquet(t.spark, f"{t.folder}/lineitem.parquet").select("l_orderkey", "l_quantity")


@query("s6_scan_by_path", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t):
    path = t.scratch()
    t.orders.select("o_orderkey", "o_totalprice").write.orc(path)
    return readers.read_path(t.spark, path, "orc")


@query("s7_table_scan", "SELECT s_suppkey, s_name FROM supplier")
def _(t):
    database = t.database()
    writers.save_to_db(t.supplier.select("s_suppkey", "s_name"), database, "suppliers", overwrite_schema=True)
    return readers.read_table(t.spark, database, "suppliers")


@query("s8_inline_rows", "SELECT c_custkey, code FROM customer JOIN (VALUES ('BUILDING', 1), ('MACHINERY', 2)) v(segment, code) ON c_mktsegment = segment")
def _(t):
    codes = readers.inline_table(t.spark, [("BUILDING", 1), ("MACHINERY", 2)], ["c_mktsegment", "code"])
    return t.customer.join(codes.withColumn("code", F.col("code").cast("int")), "c_mktsegment").select("c_custkey", "code")


COUNTRY = {0: "BR", 1: "CA", 2: "DE", 3: "FR", 4: "GB"}


@query(
    "s9_country_files",
    """SELECT c_custkey::VARCHAR AS video_id, c_name AS title, ['BR', 'CA', 'DE', 'FR', 'GB'][n_regionkey + 1] AS country_dataset
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def _(t):
    path = t.scratch()
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = customers.select(
        F.concat(map_literal(COUNTRY)[F.col("n_regionkey")], F.lit("_trending_data")).alias("dataset"),
        F.col("c_custkey").alias("video_id"), F.col("c_name").alias("title"), F.lit("d").alias("description"),
    )
    # One folder per country, as the scan expects: .../XX_trending_data/part-*.csv
    for country in COUNTRY.values():
        folder = f"{country}_trending_data"
        writers.write_csv(rows.where(F.col("dataset") == folder).drop("dataset"), f"{path}/{folder}")
    return readers.read_country_files(t.spark, f"{path}/*", "video_id string, title string, description string")


@query(
    "s10_category_names",
    "SELECT p_partkey, n_name AS category_name FROM part LEFT JOIN nation ON p_size = n_nationkey",
)
def _(t):
    path = t.scratch()
    item = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.struct(F.col("n_name").alias("title")).alias("snippet"))
    t.nation.groupBy("n_regionkey").agg(F.collect_list(item).alias("items")).drop("n_regionkey").write.json(path)
    lookup = readers.read_category_lookup(t.spark, path, multi_line=False)
    return readers.add_category_name(t.part.select("p_partkey", F.col("p_size").alias("category_id")), lookup).drop("category_id")


@query(
    "s10_country_category_names",
    """SELECT p_partkey, country, CASE WHEN n.n_nationkey IS NOT NULL THEN n_name || ' ' || country END AS category_name
       FROM (SELECT p_partkey, p_size, CASE WHEN p_partkey % 2 = 0 THEN 'BR' ELSE 'CA' END AS country FROM part) p
       LEFT JOIN nation n ON p_size = n_nationkey AND (country = 'BR' OR n_nationkey < 10)""",
)
def _(t):
    path = t.scratch()
    # Both countries name the first ten ids, differently; the others are known in one country only.
    for country, limit in (("BR", 1000), ("CA", 10)):
        name = F.concat("n_name", F.lit(f" {country}"))
        item = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.struct(name.alias("title")).alias("snippet"))
        known = t.nation.where(F.col("n_nationkey") < limit)
        known.groupBy("n_regionkey").agg(F.collect_list(item).alias("items")).drop("n_regionkey").write.json(f"{path}/{country}_category_id")
    lookup = readers.read_category_lookup(t.spark, f"{path}/*", multi_line=False, country="country")
    country = F.when(F.col("p_partkey") % 2 == 0, "BR").otherwise("CA")
    parts = t.part.select("p_partkey", F.col("p_size").alias("category_id"), country.alias("country"))
    return readers.add_category_name(parts, lookup, country="country").drop("category_id")


@query(
    "s11_appended_table",
    """SELECT c_custkey, c_name, NULL::DOUBLE AS c_acctbal FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""",
)
def _(t):
    database = t.database()
    writers.save_to_db(t.supplier, database, "people", overwrite_schema=True)
    writers.save_to_db(t.customer.select("c_custkey", "c_name"), database, "people", overwrite_schema=True)
    more = t.supplier.select(F.col("s_acctbal").alias("c_acctbal"), F.col("s_suppkey").alias("c_custkey"))
    writers.save_to_db(more, database, "people")
    return readers.read_table(t.spark, database, "people")


@query(
    "s12_replaced_partitions",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders""",
)
def _(t):
    database = t.database()
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.save_to_db2(rows, database, "orders", ["o_orderstatus"])
    finished = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    writers.save_to_db2(finished.select("o_orderstatus", "o_totalprice", "o_orderkey"), database, "orders")
    return readers.read_table(t.spark, database, "orders")


@query(
    "s13_merged_table",
    """SELECT c_custkey AS show_id, CASE WHEN c_nationkey < 5 THEN c_acctbal + 1 ELSE c_acctbal END AS balance,
       CASE WHEN c_nationkey < 5 THEN DATE '2024-05-06' ELSE DATE '2000-01-01' END AS last_updated_date FROM customer WHERE c_nationkey <> 4
       UNION ALL SELECT c_custkey, c_acctbal + 1, DATE '2024-05-06' FROM customer WHERE c_nationkey = 4""",
)
def _(t):
    database = t.database()
    base = t.scratch()
    before = t.customer.where("c_nationkey <> 4").select(
        F.col("c_custkey").alias("show_id"), F.col("c_acctbal").alias("balance"), F.lit("2000-01-01").cast("date").alias("last_updated_date")
    )
    writers.publish(before, f"{database}.shows", base)
    updates = t.customer.where("c_nationkey < 5").select(
        F.col("c_custkey").alias("show_id"), (F.col("c_acctbal") + 1).alias("balance"), F.lit(None).cast("date").alias("last_updated_date")
    )
    view = f"{database}_updates"
    writers.expose_view(updates, view)
    writers.merge_tables(t.spark, database, "shows", view, run_date="2024-05-06", base_path=base)
    # Once more: an upsert of the same rows changes nothing.
    return writers.merge_tables(t.spark, database, "shows", view, run_date="2024-05-06", base_path=base)


@query(
    "s13_merged_buckets",
    """WITH updates AS (SELECT o_orderkey + 7000 AS show_id, o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT')
       SELECT o_orderkey AS show_id, o_totalprice AS price FROM orders WHERE o_orderkey NOT IN (SELECT show_id FROM updates)
       UNION ALL FROM updates""",
)
def _(t):
    database, base = t.database(), t.scratch()
    orders = t.orders.select(F.col("o_orderkey").alias("show_id"), F.col("o_totalprice").alias("price"), "o_orderpriority")
    writers.publish_bucketed(orders.drop("o_orderpriority"), f"{database}.orders", "show_id", 16, base)
    urgent = orders.where("o_orderpriority = '1-URGENT'").select((F.col("show_id") + 7000).alias("show_id"), "price")
    view = f"{database}_updates"
    writers.expose_view(urgent, view)
    return writers.merge_tables(t.spark, database, "orders", view, base_path=base).drop("key_bucket")


@query(
    "s13_partitioned_merge",
    """SELECT o_orderkey AS show_id, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS price, o_orderstatus AS status, ['status'] AS partitions FROM orders
       UNION ALL SELECT NULL, 1.0, 'F', ['status'] UNION ALL SELECT NULL, 2.0, 'O', ['status']""",
)
def _(t):
    database, base = t.database(), t.scratch()
    orders = t.orders.select(F.col("o_orderkey").alias("show_id"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"), "o_orderpriority")
    writers.publish(orders.drop("o_orderpriority"), f"{database}.orders", base, ["status"])
    urgent = orders.where("o_orderpriority = '1-URGENT'").select("show_id", (F.col("price") + 1).alias("price"), "status")
    # Every update twice, and two without a key, which are both added.
    nameless = t.spark.sql("SELECT CAST(NULL AS BIGINT) AS show_id, v.price, v.status FROM VALUES (1.0D, 'F'), (2.0D, 'O') AS v(price, status)")
    view = f"{database}_updates"
    writers.expose_view(urgent.unionByName(urgent).unionByName(nameless), view)
    merged = writers.merge_tables(t.spark, database, "orders", view, base_path=base)
    partitions = [c.name for c in t.spark.catalog.listColumns(f"{database}.orders") if c.isPartition]
    return merged.withColumn("partitions", F.array(*[F.lit(p) for p in partitions]))


@query(
    "s13_merged_maps",
    """SELECT o_orderkey AS show_id, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE o_orderstatus END AS blocked FROM orders""",
)
def _(t):
    database, base = t.database(), t.scratch()
    orders = t.orders.select(F.col("o_orderkey").alias("show_id"), F.create_map(F.lit("blocked"), F.array("o_orderstatus")).alias("restriction"))
    writers.publish_bucketed(orders, f"{database}.orders", "show_id", 8, base)
    new = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("show_id"), F.create_map(F.lit("blocked"), F.array(F.lit("new"))).alias("restriction"))
    view = f"{database}_updates"
    writers.expose_view(new.unionByName(new), view)
    merged = writers.merge_tables(t.spark, database, "orders", view, base_path=base)
    return merged.select("show_id", F.col("restriction")["blocked"][0].alias("blocked"))


@query(
    "s13_model_by_slices",
    """WITH parts AS (
         SELECT o_orderkey AS show_id, o_orderpriority AS label FROM orders WHERE o_orderstatus <> 'F'
         UNION ALL SELECT o_orderkey, o_orderpriority || ' late' FROM orders WHERE o_orderstatus = 'F'
       )
       SELECT show_id, label FROM parts UNION ALL SELECT show_id, 'all' FROM parts""",
)
def _(t):
    database, base = t.database(), t.scratch()
    orders = t.orders.select(F.col("o_orderkey").alias("show_id"), F.col("o_orderpriority").alias("label"), "o_orderstatus")
    # All orders on the first day, and the finished ones anew, with other labels, on the second.
    late = orders.where("o_orderstatus = 'F'").withColumn("label", F.concat("label", F.lit(" late")))
    for day in (orders, late):
        shows = day.select("show_id", "o_orderstatus")
        named = day.select("show_id", F.explode(F.array("label", F.lit("all"))).alias("label")).withColumn("label_id", hashed_id(F.col("label")))
        labels = named.select("label_id", "label").distinct()
        writers.merge_model(t.spark, database, {"shows": (shows, "show_id"), "labels": (labels, "label_id")}, {"shows_labels": (named.select("show_id", "label_id"), "show_id")}, base_path=base)
    tables = {name: readers.read_table(t.spark, database, name) for name in ("shows", "labels", "shows_labels")}
    bridge = joins.dimension_lookup(tables["shows_labels"], tables["labels"], "label_id", ["label"], "inner", counted=True)
    return joins.dimension_lookup(bridge, tables["shows"], "show_id", ["o_orderstatus"], "inner").select("show_id", "label")


@query(
    "s13_values_lost",
    """SELECT o_orderkey AS show_id, o_orderpriority AS label FROM orders WHERE o_orderstatus <> 'F'
       UNION ALL SELECT NULL, 'nameless'""",
)
def _(t):
    database, base = t.database(), t.scratch()
    orders = t.orders.select(F.col("o_orderkey").alias("show_id"), F.col("o_orderpriority").alias("label"), "o_orderstatus")
    nameless = t.spark.sql("SELECT CAST(NULL AS BIGINT) AS show_id, 'nameless' AS label")
    # On the second day the finished orders come without any label, and lose theirs. Each day is merged twice.
    for day, labels in ((orders, orders), (orders.where("o_orderstatus = 'F'"), orders.limit(0))):
        for _ in range(2):
            bridge = labels.select("show_id", "label").unionByName(nameless)
            writers.merge_model(t.spark, database, {"shows": (day.select("show_id", "o_orderstatus"), "show_id")}, {"labels": (bridge, "show_id")}, base_path=base)
    return readers.read_table(t.spark, database, "labels").select("show_id", "label")


@query("s14_checkpoint", "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS doubled FROM orders")
def _(t):
    table = f"{t.database()}.checkpoint"
    base = t.scratch()
    first = writers.save_checkpoint(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), table, base)
    # Reads the checkpoint it replaces, with another schema.
    doubled = first.select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("doubled"))
    return writers.save_checkpoint(doubled, table, base)


@query(
    "s14_signed_checkpoint",
    "SELECT c_custkey, builds FROM customer JOIN (VALUES (1, 1), (1, 1), (2, 2), (2, 3)) v(half, builds) ON c_custkey % 2 = 1 OR half = 2",
)
def _(t):
    path, base, table, builds = t.scratch(), t.scratch(), f"{t.database()}.checkpoint", []

    def build():
        builds.append(1)
        return t.spark.read.parquet(path).withColumn("builds", F.lit(len(builds)))

    def saved(**arguments):
        rows = writers.checkpoint_or_build(t.spark, table, build, [t.spark.read.parquet(path)], arguments, base)
        return durable(rows)

    t.customer.where("c_custkey % 2 = 1").select("c_custkey").write.parquet(path)
    # Built, found, built anew with more rows and with another argument.
    found = [saved(), saved()]
    t.customer.where("c_custkey % 2 = 0").select("c_custkey").write.mode("append").parquet(path)
    found += [saved(), saved(year=2024)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query("s15_checkpoint_or_rebuild", "SELECT event_id, user_id, 'built' AS origin FROM events UNION ALL SELECT event_id, user_id, 'saved' FROM events")
def _(t):
    path = t.scratch()
    rows = t.events.select("event_id", "user_id")
    build = lambda: rows.withColumn("origin", F.lit("built"))
    built = readers.read_or_build(lambda: readers.read_path(t.spark, path), build)
    rows.withColumn("origin", F.lit("saved")).write.parquet(path)
    return built.unionByName(readers.read_or_build(lambda: readers.read_path(t.spark, path), build))


@query("s16_tables_defined", "SELECT n_nationkey, n_name, NULL::DATE AS last_updated_date FROM nation")
def _(t):
    database = t.database()
    writers.create_database(t.spark, database)
    for _ in range(2):
        writers.create_table(t.spark, database, "nations", "n_nationkey int, n_name string, last_updated_date date")
    writers.save_to_db(t.nation.select("n_name", "n_nationkey"), database, "nations")
    return readers.read_table(t.spark, database, "nations")


@query("s17_renamed_table", "SELECT r_regionkey, r_name FROM region")
def _(t):
    database = t.database()
    writers.save_to_db(t.region, database, "old_name", overwrite_schema=True)
    writers.rename_table(t.spark, database, "old_name", "new_name")
    return readers.read_table(t.spark, database, "new_name")


@query("s18_view", "SELECT p_brand, avg(p_size) AS mean_size FROM part GROUP BY p_brand")
def _(t):
    writers.expose_view(t.part, "reelsift_parts")
    return t.spark.sql("SELECT p_brand, avg(p_size) AS mean_size FROM reelsift_parts GROUP BY p_brand")


@query(
    "s19_date_slice",
    """SELECT event_id, 'slice' AS kind FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'
       UNION ALL SELECT event_id, 'all' FROM events""",
)
def _(t):
    path = t.scratch()
    dated = t.events.select("event_id", F.col("ts").cast("date").alias("last_updated_date"))
    dated.write.partitionBy("last_updated_date").parquet(path)
    stored = readers.read_parquet(t.spark, path)
    sliced = readers.slice_by_date(stored, "2024-01-05").select("event_id", F.lit("slice").alias("kind"))
    return sliced.union(readers.slice_by_date(stored).select("event_id", F.lit("all")))


def clustered_events(t):
    dated = t.events.select("event_id", "user_id", "ts", F.col("ts").cast("date").alias("last_updated_date"))
    return writers.publish_clustered(dated, f"{t.database()}.events", ["last_updated_date", "user_id", "event_id"], "user_id", t.scratch(), rows_per_page=100)


@query("s19_clustered_slice", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'")
def _(t):
    return readers.slice_by_date(clustered_events(t), "2024-01-05").select("event_id", "user_id")


@query("s7_key_lookup", "SELECT event_id, ts FROM events WHERE user_id = 7")
def _(t):
    return clustered_events(t).where("user_id = 7").select("event_id", "ts")
