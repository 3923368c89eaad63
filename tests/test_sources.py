import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift import schemas, session
from reelsift.sources import readers, writers
from reelsift.streaming import incremental


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


def shows(spark, *data):
    return spark.createDataFrame(list(data), "show_id string, v int, last_updated_date date")


OLD, RUN = date(2020, 1, 1), date(2024, 5, 6)


def test_upsert(spark):
    target = shows(spark, ("a", 1, OLD), ("b", 2, OLD), ("c", 3, OLD))
    updates = shows(spark, ("b", 20, None), ("d", 4, None), ("d", 5, None))
    once = writers.upsert(target, updates, run_date="2024-05-06")
    assert rows(once) == [("a", 1, OLD), ("b", 20, RUN), ("c", 3, OLD), ("d", 4, RUN)]
    assert rows(writers.upsert(once, updates, run_date="2024-05-06")) == rows(once)
    assert rows(writers.upsert(target, updates, run_date=RUN, order_by=[F.col("v").desc()]))[-1] == ("d", 5, RUN)
    with pytest.raises(ValueError):
        writers.upsert(target, updates, on_duplicate="raise")


def test_merge_switches_the_folder(spark, database, tmp_path):
    base = str(tmp_path / "data")
    writers.publish(shows(spark, ("a", 1, OLD)), f"{database}.t", base)
    before = spark.table(f"{database}.t").inputFiles()
    writers.expose_view(shows(spark, ("a", 9, None), ("b", 2, None)), "updates_view")
    merged = writers.merge_tables(spark, database, "t", "updates_view", run_date=RUN, base_path=base)
    assert rows(merged) == [("a", 9, RUN), ("b", 2, RUN)]
    assert set(before).isdisjoint(merged.inputFiles())
    assert rows(spark.read.parquet(*before)) == [("a", 1, OLD)]


def test_merge_into_partitioned_table(spark, database, tmp_path):
    base = str(tmp_path / "data")
    first = writers.publish(shows(spark, ("a", 1, OLD), ("b", 2, OLD)), f"{database}.p", base, ["last_updated_date"])
    assert rows(first) == [("a", 1, OLD), ("b", 2, OLD)]
    writers.expose_view(shows(spark, ("a", 9, None)), "updates_p")
    merged = writers.merge_tables(spark, database, "p", "updates_p", run_date=RUN, base_path=base, partition_by=["last_updated_date"])
    assert rows(merged) == [("a", 9, RUN), ("b", 2, OLD)]
    assert "PartitionFilters: [isnotnull(last_updated_date" in plan(readers.slice_by_date(merged, "2024-05-06"))


def test_merge_rewrites_only_touched_buckets(spark, database, tmp_path):
    base, name = str(tmp_path / "data"), f"{database}.b"
    many = spark.range(200).select(F.col("id").cast("string").alias("show_id"), F.lit(1).alias("v"), F.lit(OLD).alias("last_updated_date"))
    before = set(writers.publish_bucketed(many, name, "show_id", 8, base).inputFiles())
    for _ in range(2):
        writers.expose_view(shows(spark, ("7", 9, None), ("new", 2, None)), "updates_b")
        merged = writers.merge_tables(spark, database, "b", "updates_b", run_date=RUN, base_path=base)
        assert merged.count() == 201
        assert rows(merged.where("v > 1"), "show_id", "v", "last_updated_date") == [("7", 9, RUN), ("new", 2, RUN)]
    kept = before & set(merged.inputFiles())
    assert len(before) - len(kept) in (1, 2)
    assert merged.where(F.col("key_bucket") != writers.key_bucket("show_id", 8)).count() == 0


def test_merge_statement_parses(spark):
    text = writers.merge_statement("db.t", "v", ["show_id", "v", "last_updated_date"])
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    assert text.count("current_date()") == 2


def test_checkpoint_may_change_its_schema(spark, database, tmp_path):
    table, base = f"{database}.c", str(tmp_path / "c")
    first = writers.save_checkpoint(spark.range(3), table, base)
    second = writers.save_checkpoint(first.withColumn("x", F.lit("y")), table, base)
    assert rows(second) == [(0, "y"), (1, "y"), (2, "y")]
    assert rows(spark.table(table)) == rows(second)


def test_append_and_replace(spark, database):
    writers.save_to_db(spark.range(2), database, "t", overwrite_schema=True)
    writers.save_to_db(spark.range(1).withColumn("x", F.lit("n")), database, "t")
    assert rows(spark.table(f"{database}.t")) == [(0, "n"), (0, None), (1, None)]
    writers.save_to_db(spark.range(1).select(F.lit("z").alias("q")), database, "t", overwrite_schema=True)
    assert rows(spark.table(f"{database}.t")) == [("z",)]


def test_dynamic_partitions(spark, database):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    writers.save_to_db2(df, database, "t", ["p"])
    writers.save_to_db2(spark.createDataFrame([("b", 9)], "p string, v int"), database, "t")
    assert rows(spark.table(f"{database}.t")) == [(1, "a"), (9, "b")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "hi",\nthen', 1), (None, "", 2)], "video_id string, title string, view_count bigint")
    writers.write_csv(df, str(tmp_path / "csv"))
    back = readers.read_media_csv(spark, str(tmp_path / "csv"), df.schema)
    assert back.where("view_count = 1").collect()[0].title == 'say "hi",\nthen'
    assert readers.load_csv(spark, str(tmp_path / "csv")).count() == 2


def test_country_files_in_one_scan(spark, tmp_path):
    header = "video_id,title,publishedAt,channelId,channelTitle,categoryId,trending_date,tags,view_count,likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,description\n"
    line = "{0},t,2024-01-01T00:00:00Z,c,n,10,2024-01-02T00:00:00Z,a|b,5,1,0,0,l,True,False,\"long\ntext\"\n"
    for country in ("US", "BR"):
        (tmp_path / f"{country}_trending.csv").write_text(header + line.format(country.lower()))
    ddl = schemas.RAW_TRENDING.rsplit(", category_name", 1)[0] + ", description string"
    df = readers.read_country_files(spark, str(tmp_path), ddl)
    assert rows(df, "video_id", "country_dataset", "channel_id") == [("br", "BR", "c"), ("us", "US", "c")]
    assert "description" not in df.columns and "published_at" in df.columns
    (tmp_path / "cats").mkdir()
    (tmp_path / "cats" / "US_category_id.json").write_text('{"items": [{"id": "10",\n "snippet": {"title": "Music"}}]}')
    named = readers.add_category_name(df, readers.read_category_lookup(spark, str(tmp_path / "cats")))
    assert {r.category_name for r in named.collect()} == {"Music"}


def test_read_or_build(spark, tmp_path):
    path = str(tmp_path / "missing")
    load = lambda: readers.read_path(spark, path)
    assert readers.read_or_build(load, lambda: spark.range(1)).count() == 1
    spark.range(5).write.parquet(path)
    assert readers.read_or_build(load, lambda: spark.range(1)).count() == 5


def test_inline_table_has_a_known_size(spark):
    df = readers.inline_table(spark, [("a", 1.5), ("b", None)], ["k", "v"])
    assert rows(df) == [("a", 1.5), ("b", None)]
    big = spark.range(10).withColumn("k", F.col("id").cast("string"))
    assert "BroadcastHashJoin" in plan(big.join(df, "k", "left"))


class Session:
    """Stands for a session with a given master and settings."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: settings.get(name, default))})


def test_shared_folder_is_taken_from_the_session():
    named = Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert session.shared_root(named) == "hdfs:///shared"
    assert session.shared_root(Session("local[2]")).startswith("/")
    with pytest.raises(ValueError):
        session.shared_root(Session("yarn"))


def test_arriving_files_are_upserted(spark, database, tmp_path):
    base, inbox = str(tmp_path / "base"), str(tmp_path / "inbox")
    target = f"{database}.s"
    writers.publish(shows(spark, ("a", 1, OLD)), target, base)
    shows(spark, ("a", 2, None), ("b", 1, None)).coalesce(1).write.parquet(inbox)
    stream = incremental.watch_folder(spark, inbox, "show_id string, v int, last_updated_date date")
    for _ in range(2):
        incremental.start_upsert(stream, target, "show_id", str(tmp_path / "ckpt"), base).awaitTermination()
        assert rows(spark.table(target), "show_id", "v") == [("a", 2), ("b", 1)]
        shows(spark, ("a", 2, None)).coalesce(1).write.mode("append").parquet(inbox)
