import uuid

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.operators import dims, ranking
from reelsift.sources import writers
from reelsift.sources.keytable import KeyTable, nth_hash


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def ids(table):
    return {r.value: r.id for r in table.rows().collect()}


def test_dense_ids_go_on(spark, database, tmp_path):
    keys = KeyTable(spark, f"{database}.k", base_path=str(tmp_path / "k"))
    assert rows(keys.extend(names(spark, "b", "a", None, "b"), "name")) == [("a", 1), ("b", 2)]
    assert rows(keys.extend(names(spark, "0", "b", "z"), "name")) == [("0", 3), ("b", 2), ("z", 4)]
    again = KeyTable(spark, f"{database}.k")
    again.extend(names(spark, "0", "b", "z"), "name")
    assert ids(again) == {"a": 1, "b": 2, "0": 3, "z": 4}
    assert rows(again.with_ids(names(spark, "z", "none", None), "name", "id"), "id") == [(4,), (None,), (None,)]


def test_only_new_values_are_written(spark, database, tmp_path):
    keys = KeyTable(spark, f"{database}.k", base_path=str(tmp_path / "k"), parts=4)
    keys.extend(spark.range(500).selectExpr("cast(id as string) AS name"), "name")
    before = set(keys.rows().inputFiles())
    keys.extend(spark.range(490, 501).selectExpr("cast(id as string) AS name"), "name")
    after = set(keys.rows().inputFiles())
    assert before < after and spark.read.parquet(*(after - before)).count() == 1 and keys.highest() == 501
    keys.extend(spark.range(501).selectExpr("cast(id as string) AS name"), "name")
    assert set(keys.rows().inputFiles()) == after


def weak(value, attempt):
    """Twenty values at the first attempt, and a hundred at the second."""
    return F.pmod(nth_hash(value, attempt), F.lit(20 * 5**attempt)) if attempt < 3 else nth_hash(value, attempt)


def test_forced_collisions_are_told_apart(spark, database, tmp_path):
    keys = KeyTable(spark, f"{database}.h", "hashed", base_path=str(tmp_path / "h"), hashes=weak)
    keys.extend(spark.range(30).selectExpr("cast(id as string) AS name"), "name")
    first = ids(keys)
    assert len(set(first.values())) == 30 and {r.attempt for r in keys.rows().collect()} > {0, 1}
    keys.extend(spark.range(200).selectExpr("cast(id as string) AS name"), "name")
    second = ids(keys)
    assert len(set(second.values())) == 200 and {v: second[v] for v in first} == first
    looked_up = keys.with_ids(spark.range(200).selectExpr("cast(id as string) AS name"), "name", "id")
    assert dict(rows(looked_up, "name", "id")) == second
    assert ranking.id_collisions(keys.dimension("name", "id"), "id").isEmpty()


def test_plain_hashes_need_no_shuffle(spark, database, tmp_path):
    keys = KeyTable(spark, f"{database}.h", "hashed", base_path=str(tmp_path / "h"))
    keys.extend(names(spark, "a", "b"), "name")
    found = keys.with_ids(names(spark, "a", "b", None), "name", "id")
    assert rows(found, "id") == rows(names(spark, "a", "b", None).select(F.when(F.col("name").isNotNull(), ranking.hashed_id(F.col("name")))))
    assert "Exchange hashpartitioning" not in plan(found)


def test_kinds_of_ids_do_not_mix(spark, database, tmp_path):
    KeyTable(spark, f"{database}.k", base_path=str(tmp_path / "k"))
    with pytest.raises(ValueError):
        KeyTable(spark, f"{database}.k", "hashed")
    with pytest.raises(ValueError):
        KeyTable(spark, f"{database}.other", "random")


def test_slices_of_a_model_agree(spark, database, tmp_path):
    base = str(tmp_path / "base")
    keys = KeyTable(spark, f"{database}.genre_keys", base_path=base)
    days = [[(1, "drama, crime"), (2, "crime, comedy"), (3, "drama")], [(1, None), (3, "comedy, animation"), (4, "crime")]]
    for day in days:
        shows = spark.createDataFrame(day, "show_id int, genres string")
        for _ in range(2):  # a slice that is run again changes nothing
            dimension, bridge = dims.keyed_dimension_and_bridge(shows, keys, "genres", "genre", "show_id", "genre_id")
            writers.merge_model(spark, database, {"shows": (shows, "show_id"), "genres": (dimension, "genre_id")}, {"show_genres": (bridge, "show_id")}, base_path=base)
    assert rows(spark.table(f"{database}.genres"), "genre", "genre_id") == [("animation", 4), ("comedy", 1), ("crime", 2), ("drama", 3)]
    # Show 1 came without genres the second time and has lost the ones it had.
    assert rows(spark.table(f"{database}.show_genres"), "show_id", "genre_id") == [(2, 1), (2, 2), (3, 1), (3, 4), (4, 2)]


def test_bridge_rows_without_key_are_replaced(spark, database, tmp_path):
    shows = spark.createDataFrame([(1, 10), (None, 11), (None, 12)], "show_id int, genre_id int")
    for _ in range(3):
        writers.merge_model(spark, database, {}, {"b": (shows, "show_id")}, base_path=str(tmp_path / "b"))
    assert rows(spark.table(f"{database}.b"), "show_id", "genre_id") == [(1, 10), (None, 11), (None, 12)]


def test_a_slice_rewrites_the_buckets_it_touches(spark, database, tmp_path):
    base, table = str(tmp_path / "b"), f"{database}.b"
    pairs = spark.range(400).selectExpr("id AS show_id", "id % 7 AS genre_id")
    writers.merge_model(spark, database, {}, {"b": (pairs, "show_id")}, base_path=base, buckets=8)
    before = set(spark.table(table).inputFiles())
    day = pairs.where("show_id = 5").withColumn("genre_id", F.lit(9).cast("bigint"))
    writers.merge_model(spark, database, {}, {"b": (day, "show_id", pairs.where("show_id IN (5, 6)"))}, base_path=base)
    assert spark.table(table).count() == 399 and rows(spark.table(table).where("show_id IN (5, 6)"), "genre_id") == [(9,)]
    assert len(before - set(spark.table(table).inputFiles())) in (1, 2)
