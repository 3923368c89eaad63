"""Marts by slices: equal to the marts over all rows, and what they read."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.plans import marts, running
from reelsift.sources import writers

SCHEMA = "video_id int, trending_date timestamp, country_dataset string, view_count bigint, likes bigint, noise string"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


def facts(spark, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 29)
    data = [
        (rng.choice([7, rng.randint(1, 60)]), start + timedelta(days=rng.randint(0, 5)), rng.choice(["US", "DE", None]), rng.choice([None, 0, 5, 50, 500]), rng.choice([None, 1, 9]), "x")
        for _ in range(600)
    ]
    return spark.createDataFrame(data, SCHEMA).cache()


@pytest.fixture
def dimensions(spark):
    bridge = spark.range(1, 61).selectExpr("CAST(id AS int) AS video_id", "explode(array(id % 5, 9)) AS tag_id")
    tags = spark.createDataFrame([(k, f"tag{k}") for k in range(10)], "tag_id long, tag string")
    videos = spark.range(1, 50).selectExpr("CAST(id AS int) AS video_id", "nullif(concat('c', id % 4), 'c0') AS category_name")
    return bridge, tags, videos


def rounded(df):
    return rows(df.select(*[F.round(c, 9).alias(c) if t == "double" else c for c, t in df.dtypes]))


def agree(state, all_rows, bridge, tags, videos):
    assert rounded(state.tag_statistics(bridge, tags, min_videos=2)) == rounded(marts.tag_statistics(all_rows, bridge, tags, min_views=40, min_videos=2))
    assert rounded(state.top_tags_per_country(bridge, tags, k=3)) == rounded(marts.top_tags_per_country(all_rows, bridge, tags, min_views=40, k=3))
    assert rounded(state.category_distribution(videos)) == rounded(marts.category_distribution(all_rows, videos))
    monthly = marts.monthly_category_distribution(all_rows, videos).withColumn("month", F.to_date("month"))
    assert rounded(state.monthly_category_distribution(videos)) == rounded(monthly)


def test_marts_by_slices(spark, database, dimensions):
    all_rows = facts(spark)
    state = running.TrendingState(spark, database, "state", min_views=40)
    days = [f"day(trending_date) IN ({d})" for d in ("29, 30", "31, 1", "2, 3")]
    for day in days:
        state.absorb(all_rows.where(day))
        state.absorb(all_rows.where(day))  # the same slice again
    agree(state, all_rows, *dimensions)
    # A day comes corrected: other rows, fewer of them.
    corrected = facts(spark, 2).where("day(trending_date) = 31").limit(20)
    corrected = corrected.withColumn("view_count", F.lit(77).cast("bigint"))
    state.absorb(corrected)
    agree(state, all_rows.where("day(trending_date) != 31").unionByName(corrected), *dimensions)


def test_more_rows_of_a_period(spark, database, dimensions):
    all_rows = facts(spark)
    state = running.TrendingState(spark, database, "state", period="month", min_views=40)
    for share in ("view_count IS NULL", "view_count <= 50", "view_count > 50"):
        state.absorb(all_rows.where(share), whole_periods=False)
    agree(state, all_rows, *dimensions)


def test_a_slice_touches_its_periods_alone(spark, database):
    all_rows = facts(spark)
    state = running.TrendingState(spark, database, "state")
    state.absorb(all_rows)
    before = set(state.rows().inputFiles())
    state.absorb(all_rows.where("day(trending_date) = 30"), whole_periods=False)
    after = set(state.rows().inputFiles())
    assert all("period=2024-01-30" in f for f in before ^ after) and before & after
    assert state.rows().where("day(period) = 30").agg(F.sum("rows")).first()[0] == 2 * all_rows.where("day(trending_date) = 30").count()


def test_marts_read_the_state_and_not_the_facts(spark, database, dimensions, tmp_path):
    path = str(tmp_path / "facts")
    facts(spark).write.parquet(path)
    state = running.TrendingState(spark, database, "state", min_views=40)
    state.absorb(spark.read.parquet(path))
    bridge, tags, videos = dimensions
    for mart in (state.tag_statistics(bridge, tags), state.top_tags_per_country(bridge, tags), state.monthly_category_distribution(videos)):
        text = plan(mart)
        assert path not in text and "state" in text
    # Rows are summed before they are shuffled.
    assert "partial_sum" in plan(state.summed(spark.read.parquet(path))).split("Exchange")[-1]


def test_more_rows_are_summed_once_with_the_tables(spark, database, monkeypatch):
    written, durable = [], running.durable
    monkeypatch.setattr(running, "durable", lambda df: written.append(df) or durable(df))
    all_rows = facts(spark)
    whole = running.TrendingState(spark, database, "whole", period="month", min_views=40)
    whole.absorb(all_rows)
    parts = running.TrendingState(spark, database, "parts", period="month", min_views=40)
    parts.absorb(all_rows.where("likes > 1"))
    parts.absorb(all_rows.where("likes IS NULL OR likes <= 1"), whole_periods=False)
    # The new rows are written as they came, and nothing else is.
    assert len(written) == 1 and "Aggregate" not in plan(written[0])
    assert rounded(parts.rows()) == rounded(whole.rows()) and parts.rows().schema == whole.rows().schema


def test_rows_are_sorted_by_their_video_first(spark, database):
    text = plan(running.TrendingState(spark, database, "state", period="quarter").summed(facts(spark)))
    assert text.count("Sort [video_id") == 2
    assert "first" in text and "country," not in text.split("partial_min(")[1].split("]")[0]


def test_periods_are_those_of_the_time(spark, database):
    for unit in ("year", "quarter", "month", "week", "Week", "day", "hour"):
        state = running.TrendingState(spark, database, "state", period=unit)
        same = F.col("period").eqNullSafe(F.date_trunc(unit, "trending_date").cast("date")) & F.col("month").eqNullSafe(F.date_trunc("month", "trending_date").cast("date"))
        assert state._dated(facts(spark).unionByName(facts(spark).limit(1).withColumn("trending_date", F.lit(None).cast("timestamp")))).where(~same).isEmpty()
