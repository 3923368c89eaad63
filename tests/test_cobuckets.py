"""Tables in the same buckets: joins without a shuffle, and merges that keep the layout."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.plans import marts
from reelsift.sources import writers


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


@pytest.fixture
def no_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    yield
    spark.conf.set(setting, before)


def facts(spark, n=400):
    return spark.range(n).select(
        (F.col("id") % 37).alias("video_id"), F.timestamp_seconds(F.col("id") * 86400).alias("trending_date"), F.lit("US").alias("country_dataset"),
        F.col("id").alias("view_count"), F.col("id").alias("likes"), F.lit(0).alias("dislikes"), F.lit(0).alias("comment_count"), F.year(F.timestamp_seconds(F.col("id") * 86400)).alias("year"),
    )


def videos(spark, title="t"):
    flags = [F.lit(0).alias(c) for c in ("comments_disabled", "ratings_disabled", "caption")]
    return spark.range(37).select(
        F.col("id").alias("video_id"), (F.col("id") % 5).alias("channel_id"), F.lit(title).alias("title"), F.timestamp_seconds("id").alias("published_at"), F.lit("c").alias("category_name"),
        F.lit("en").alias("default_language"), F.lit("1").alias("duration"), *flags,
    )


def test_facts_are_not_shuffled(spark, database, tmp_path, no_broadcast):
    channels = spark.range(5).select(F.col("id").alias("channel_id"), F.col("id").cast("string").alias("channel_title"))
    base = str(tmp_path / "base")
    trending = writers.publish_cobucketed(facts(spark), f"{database}.facts", "video_id", 4, base, ["year"])
    details = writers.publish_cobucketed(marts.video_details(videos(spark), channels), f"{database}.videos", "video_id", 4, base)
    found = marts.trending_with_details(trending, details)
    assert "SortMergeJoin" in plan(found) and "Exchange" not in plan(found)
    # Slices and merges leave it so.
    more = facts(spark, 800).where("year = 1972")
    trending = writers.add_slice(more, f"{database}.facts")
    details = writers.merge_updates(f"{database}.videos", marts.video_details(videos(spark, "new"), channels).where("video_id < 10"), "video_id", base_path=base)
    found = marts.trending_with_details(trending, details)
    assert "Exchange" not in plan(found)
    whole = marts.trending_with_details(facts(spark).unionByName(more), videos(spark).withColumn("title", F.when(F.col("video_id") < 10, "new").otherwise("t")), channels)
    assert rows(found) == rows(whole) and "Exchange" in plan(whole)


def test_layout_survives_publishing(spark, database, tmp_path):
    name, base = f"{database}.t", str(tmp_path / "base")
    first = writers.publish_cobucketed(spark.range(100).withColumn("x", F.lit(1)), name, ["id"], 4, base)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'films')")
    files = set(first.inputFiles())
    again = writers.publish(first.withColumn("x", F.lit(2)).where("id > 4"), name, base)
    assert rows(again.agg(F.count("*"), F.sum("x"))) == [(95, 190)] and files.isdisjoint(again.inputFiles())
    assert writers.cobuckets(spark, name) == writers.Cobuckets(4, ["id"])
    assert {r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name} ('owner_team')").collect()} == {"films"}
    assert writers.cobuckets(spark, f"{database}.t") and len(again.inputFiles()) == 4


def test_fullest_bucket_is_told(spark, database, tmp_path):
    layout = writers.Cobuckets(8, ["id"])
    assert writers.largest_bucket(spark.range(8000), layout) < 0.2
    assert writers.largest_bucket(spark.range(900).select((F.col("id") % 3 % 2).alias("id")), layout) > 0.6
    assert writers.largest_bucket(spark.range(0), layout) == 0


def test_a_plain_table_has_no_buckets(spark, database, tmp_path):
    writers.publish(spark.range(3), f"{database}.p", str(tmp_path / "p"))
    assert writers.cobuckets(spark, f"{database}.p") is None


def test_empty_partitioned_table(spark, database, tmp_path):
    empty = spark.range(0).withColumn("x", F.lit("a"))
    assert writers.publish_bucketed(empty, f"{database}.e", "id", 4, str(tmp_path / "e")).count() == 0
    writers.merge_updates(f"{database}.e", spark.range(3).withColumn("x", F.lit("b")), "id", base_path=str(tmp_path / "e"))
    assert rows(spark.table(f"{database}.e"), "id", "x") == [(0, "b"), (1, "b"), (2, "b")]


def test_data_without_a_place_goes_to_the_database(spark, database, tmp_path):
    place = spark.catalog.getDatabase(database).locationUri.replace("file:", "")
    layouts = {"plain": lambda df, t: writers.publish(df, t), "cut": lambda df, t: writers.publish_bucketed(df, t, "id", 2), "co": lambda df, t: writers.publish_cobucketed(df, t, "id", 2)}
    for name, publish in layouts.items():
        publish(spark.range(3), f"{database}.{name}")
        again = publish(spark.range(4), f"{database}.{name}")
        assert rows(again, "id") == [(0,), (1,), (2,), (3,)] and all(place in f for f in again.inputFiles())
    # A managed table that takes on another layout loses nothing when the old one is dropped.
    writers.save_to_db(spark.range(3), database, "managed", overwrite_schema=True)
    assert writers.publish(spark.range(5).withColumn("x", F.lit(1)), f"{database}.managed").count() == 5
    assert spark.table(f"{database}.managed").count() == 5


def test_buckets_grow_with_the_rows(spark, database, tmp_path, no_broadcast):
    base = str(tmp_path / "base")
    trending = writers.publish_cobucketed(facts(spark), f"{database}.facts", "video_id", 2, base, rows_per_bucket=50)
    assert writers.cobuckets(spark, f"{database}.facts").buckets == 8
    details = writers.publish_cobucketed(videos(spark), f"{database}.videos", "video_id", f"{database}.facts", base)
    found = trending.join(details, "video_id", "left")
    assert "SortMergeJoin" in plan(found) and "Exchange" not in plan(found)
    assert rows(found, "video_id", "view_count", "title") == rows(facts(spark).join(videos(spark), "video_id", "left"), "video_id", "view_count", "title")
    writers.publish_cobucketed(facts(spark), f"{database}.few", "video_id", 2, base, rows_per_bucket=200)
    assert writers.cobuckets(spark, f"{database}.few").buckets == 2
    with pytest.raises(ValueError):
        spark.range(3).write.saveAsTable(f"{database}.plain")
        writers.publish_cobucketed(videos(spark), f"{database}.more", "video_id", f"{database}.plain", base)
