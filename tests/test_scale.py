"""Shapes of plans that have to hold for any amount of data."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import plan
from reelsift.operators import ranking, stats
from reelsift.plans import cleaning, marts
from reelsift.sources import writers
from workload import REGISTRY
from workload.registry import Tables

FOLDER = "/root/testdata/sf0.001"


def facts(spark):
    return spark.range(100).select(
        (F.col("id") % 7).alias("video_id"),
        F.timestamp_seconds("id").alias("trending_date"),
        F.lit("US").alias("country_dataset"),
        (F.col("id") * 100_000).alias("view_count"),
        F.col("id").alias("likes"),
    )


def test_rows_are_summed_before_they_are_joined(spark):
    bridge = spark.range(7).select(F.col("id").alias("video_id"), F.col("id").alias("tag_id"))
    tags = spark.range(7).select(F.col("id").alias("tag_id"), F.col("id").cast("string").alias("tag"))
    text = plan(marts.top_tags_per_country(facts(spark), bridge, tags))
    # Deepest operators come last: the fact scan is followed by a partial sum, then by its first exchange.
    branch = text[: text.index("Range (0, 100")]
    assert branch.rindex("partial_sum") > branch.rindex("Exchange")
    assert branch.rindex("partial_sum") > branch.rindex("Join")


def test_one_window_finds_the_latest_videos(spark):
    raw = facts(spark).withColumns({"tags": F.lit("a|b"), "comment_count": F.lit(1)})
    text = plan(cleaning.latest_videos(raw))
    assert len(re.findall(r"Window \[", text)) == 1 and text.count("Exchange hashpartitioning") == 1


def test_row_numbers_need_no_single_partition_of_rows(spark):
    text = plan(ranking.global_row_number(spark.range(1000), "id", "n"))
    single = text[text.index("SinglePartition"):]
    # Only the sizes of the slots meet in one task.
    assert "HashAggregate" in single and text.count("SinglePartition") == 1


@pytest.mark.parametrize("name", ["a5_shares", "a6_shares_with_total", "m5_category_distribution", "m10_best_trailers", "j9_title_in_text"])
def test_no_nested_loops(spark, name):
    text = plan(REGISTRY[name].run(Tables(spark, FOLDER)))
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_workers(spark, name):
    text = plan(REGISTRY[name].run(Tables(spark, FOLDER)))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


def test_filters_and_columns_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    text = plan(REGISTRY["w8_date_range"].run(t))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_matched_texts_are_checked_and_joined_once(spark):
    # What the matches are joined with reads them, not the texts, again.
    text = plan(REGISTRY["m10_best_trailers"].run(Tables(spark, FOLDER)))
    assert "RLIKE" not in text and "documents" not in text


def test_updates_of_a_merge_are_found_once(spark):
    target = spark.range(10).select(F.col("id").alias("show_id"), F.lit(1).alias("x"))
    text = plan(writers.upsert(target, target.withColumn("x", F.lit(2))))
    assert "Window" not in text


def test_bridges_are_not_broadcast(spark, tmp_path):
    data = spark.range(300).selectExpr("id AS p_partkey", "concat('red blue ', id % 7) AS p_name", "concat('Brand', id % 5) AS p_brand", "concat('T', id % 3) AS p_type", "int(id % 50) AS p_size", "double(id) AS p_retailprice")
    data.write.parquet(str(tmp_path / "part.parquet"))
    out = REGISTRY["d2_catalogue_bridges"].run(Tables(spark, str(tmp_path)))
    assert "Broadcast" not in plan(out) and out.where("entity = 'directors'").count() > 0


def test_totals_are_joined_not_windowed(spark):
    counts = spark.range(9).select(F.lit("US").alias("c"), F.col("id").alias("k"), F.lit(1).cast("bigint").alias("n"))
    assert "Window" not in plan(stats.share_per_scope(counts, "c", "k", "n", "s"))
