import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.lookups import NON_LATIN_BLOCKS
from reelsift.operators import dedup, dims, enrich, joins, quality, ranking, reshape, schema, stats


def frame(spark, ddl, *data):
    return spark.createDataFrame(list(data), ddl)


# ---- columns


def test_schema_steps(spark):
    df = frame(spark, "a int, b boolean", (1, True), (2, None))
    assert schema.add_prefix_to_column_names(df, "new_").columns == ["new_a", "new_b"]
    assert rows(schema.convert_bool_columns_to_int(df)) == [(1, 1), (2, None)]
    assert schema.ensure_column_existence(df, "c", "int", 0).dtypes[-1] == ("c", "int")
    assert schema.ensure_column_existence(df, "a", "string", "x").dtypes == df.dtypes
    assert schema.merge_schema_into_dataframe(df, "a int, t array<string>").dtypes[-1] == ("t", "array<string>")
    assert schema.add_null_columns(df, ["a", "z"]).columns == ["a", "b", "z"]
    with pytest.raises(ValueError):
        schema.add_platform_column(df, "hulu")


def test_list_columns(spark):
    df = frame(spark, "tags string", ("a|B|a",), ("[None]",), (None,), ("",))
    out = schema.ensure_list_column(df, "tags", r"\|", "[None]")
    assert [r.tags for r in out.collect()] == [["a", "B", "a"], None, None, [""]]
    assert schema.ensure_list_column(out, "tags", r"\|").dtypes == out.dtypes


def test_prefixed_columns_coalesce(spark):
    df = frame(spark, "a int, new_a int", (1, 9), (2, None))
    assert rows(schema.coalesce_prefixed_columns(df, "new_", ["a"])) == [(2,), (9,)]


# ---- filters


def test_missing_values(spark):
    df = frame(spark, "a int, b int", (1, None), (1, 1), (None, None))
    assert quality.select_rows_with_missing_values(df).count() == 2
    assert quality.select_rows_with_missing_values(df, ["a"]).count() == 1
    assert rows(quality.count_na(df)) == [(1, 2)]


def test_missing_characters(spark):
    df = frame(spark, "t string", ("ok",), ("�?",), ("a�",), ("日本語",), (None,), ("",))
    assert rows(quality.drop_missing_character(df, "t")) == [("",), ("a�",), ("ok",), ("日本語",)]
    assert rows(quality.drop_missing_character(df, "t", ascii_words=True)) == [("",), ("a�",), ("ok",)]
    assert (None,) in rows(quality.drop_missing_character(df, "t", keep_nulls=True))
    assert rows(quality.drop_missing_character(df, ["t"], full_string=False)) == [("",), ("ok",), ("日本語",)]


def test_titles_by_script(spark):
    df = frame(spark, "title string", ("Été",), ("日本",), ("Привет",), ("नमस्ते",), ("plain",))
    assert rows(quality.filter_non_english_values(df)) == [("नमस्ते",), ("日本",)]
    assert quality.filter_non_english_values(df, exclude_non_english=True).count() == 3
    assert rows(quality.filter_with_regex_list(df, "title", [])) == rows(df)
    assert len(NON_LATIN_BLOCKS) == 6


def test_prefixes(spark):
    df = frame(spark, "t string", ("30-Minute Yoga",), ("Yoga",), ("a.c",), ("abc",), (None,))
    assert rows(quality.remove_values_by_prefix(df, "t", ["30-Minute", "a."])) == [("Yoga",), ("abc",)]


def test_whole_year(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP'2023-12-31 23:59:59', TIMESTAMP'2024-12-31 18:00:00', TIMESTAMP'2025-01-01')) AS ts")
    assert quality.filter_date_year(df, "ts", 2024).count() == 1


def test_trailer_condition(spark):
    df = frame(
        spark, "title string, category string",
        ("The Office Trailer", "Shows"), ("Office trailer RÉACTION", "Shows"), ("office trailer réaction", "Shows"),
        ("Office trailer", "GAMING"), ("Office trailer", None), ("Office gameplays trailer", "Shows"), ("Office", "Shows"),
    )
    kept = df.where(quality.trailer_condition(F.col("title"), F.col("category")))
    assert rows(kept, "title") == [("Office gameplays trailer",), ("The Office Trailer",)]


def test_members(spark):
    df = frame(spark, "c string", ("a",), ("b",), (None,))
    members = frame(spark, "m string", ("a",), ("a",))
    assert rows(quality.keep_members(df, "c", members)) == [("a",)]
    assert rows(quality.drop_members(df, "c", members)) == [("b",)]
    assert rows(quality.flag_members(df, "c", members, "f")) == [("a", 1), ("b", 0), (None, 0)]


def test_pattern_counts(spark):
    df = frame(spark, "a string, b string", ("it's x", "x"), ("y", "x"), (None, "y"))
    assert rows(quality.regexp_match_count(df, ["a", "b"], "x")) == [(1, 2, 1, 2)]
    assert rows(quality.regexp_match_count(df, ["a"], "it's")) == [(1, 1, 1)]


# ---- one row per key, ids


def test_first_row_per_key(spark):
    df = frame(spark, "k string, d int", ("a", 1), ("a", 3), ("b", 2), (None, 5), (None, 4))
    assert rows(dedup.latest_per_key(df, "k", "d")) == [("a", 3), ("b", 2), (None, 5)]
    assert rows(dedup.earliest_per_key(df, "k", "d")) == [("a", 1), ("b", 2), (None, 4)]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    text = plan(dedup.latest_per_key(spark.range(10).withColumn("k", F.col("id") % 2), "k", "id"))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_lookup_and_duplicates(spark):
    df = frame(spark, "k string, v int", ("a", 2), ("a", 1), ("b", None), (None, 3))
    assert rows(dedup.key_value_lookup(df, "k", "v")) == [("a", 1)]
    assert rows(dedup.display_duplicates(df, "k")) == [("a", 2)]


def test_global_row_number(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("n"))
    numbered = ranking.global_row_number(df, "n", "row")
    assert rows(numbered) == sorted(((i, i + 1) for i in range(1000)), key=repr)
    assert rows(numbered) == rows(numbered)


def test_dense_ids(spark):
    df = frame(spark, "tag string", ("b",), ("a",), ("b",), (None,))
    assert rows(ranking.dense_ids(df, "tag", "id")) == [("a", 2), ("b", 3), (None, 1)]


def test_batches(spark):
    batches = ranking.request_groups(spark.range(120), "id", 50).orderBy("batch_id").collect()
    assert [len(r.ids) for r in batches] == [50, 50, 20]
    assert [i for r in batches for i in r.ids] == list(range(120))


def test_top_k_has_group_limit(spark):
    df = frame(spark, "g string, n int", *[("x", i) for i in range(50)], ("y", 1))
    top = ranking.top_k_per_group(df, "g", [F.col("n").desc()], 2)
    assert rows(top) == [("x", 48, 2), ("x", 49, 1), ("y", 1, 1)]
    assert "WindowGroupLimit" in plan(top)


# ---- dimensions and bridges


def test_dimension_and_bridge(spark):
    df = frame(spark, "id int, cast string", (1, "A B, C D"), (2, " C D"), (3, None), (4, ""))
    dimension = dims.create_unique_df(df, "cast", "name", "name_id")
    assert rows(dimension, "name") == [("A B",), ("C D",)]
    bridge = dims.create_association_table(df, None, "cast", "name", "id", "name_id")
    assert rows(bridge.join(dimension, "name_id"), "id", "name") == [(1, "A B"), (1, "C D"), (2, "C D")]
    joined = dims.create_association_table(df, dimension, "cast", "name", "id", "name_id")
    assert rows(joined) == rows(bridge)
    literal = dims.create_unique_df(df, "cast", "name", "name_id", trim=False)
    assert rows(literal, "name") == [(" C D",), ("",), ("A B",)]


def test_ids_are_stable_and_unique(spark):
    df = spark.range(2000).select(F.concat(F.lit("n"), F.col("id") % 500).alias("c"))
    once, again = (dims.create_unique_df(df.repartition(n), "c", "name", "id") for n in (2, 9))
    assert rows(once) == rows(again)
    assert ranking.id_collisions(once, "id").count() == 0


# ---- unions, explodes, moves


def test_explodes(spark):
    df = frame(spark, "id int, t string", (1, "a|B"), (2, None))
    assert rows(reshape.explode_string_column(df, "t", r"\|")) == [(1, "B"), (1, "a")]
    kept = reshape.explode_string_column(df, "t", r"\|", "x", keep_old_column=True)
    assert kept.dtypes == [("id", "int"), ("t", "array<string>"), ("x", "string")]
    assert reshape.explode_string_column(df, "t", r"\|", "x").columns == ["id", "x"]
    listed = frame(spark, "id int, m map<string, array<string>>", (1, {"blocked": ["US", "DE", "US"]}), (2, {}), (3, None), (4, {"allowed": []}))
    assert rows(reshape.explode_map_of_lists(listed, "m", "kind", "country", ["id"])) == [(1, "blocked", "DE"), (1, "blocked", "US")]


def test_moved_values(spark):
    df = frame(spark, "age string, duration string", ("74 min", None), ("PG", "90 min"), (None, "x"))
    moved = reshape.move_values_between_columns(df, F.col("age").contains("min"), "duration", "age")
    assert rows(moved) == [("PG", "90 min"), (None, "74 min"), (None, "x")]


def test_not_found_rows(spark):
    found = frame(spark, "id string, v int, is_scraped int", ("a", 1, 1))
    asked = frame(spark, "id string", ("a",), ("b",), ("b",))
    assert rows(reshape.add_not_found_rows(found, asked, "id")) == [("a", 1, 1), ("b", None, -1)]


# ---- joins


def test_lookup_joins(spark):
    df = frame(spark, "id int, c string", (1, "x"), (2, "y"))
    assert rows(joins.map_column(df, frame(spark, "c string, n int", ("x", 7)), "n", "c")) == [(1, 7), (2, None)]
    fixes = frame(spark, "id int, fix string", (2, "z"))
    assert rows(joins.override_column(df, fixes, "id", "c", "fix")) == [(1, "x"), (2, "z")]
    assert rows(joins.replace_rows(df, frame(spark, "c string, id int", ("q", 2)), "id")) == [(1, "x"), (2, "q")]
    with pytest.raises(ValueError):
        joins.replace_rows(df, frame(spark, "id int, c int", (2, 5)), "id")


# ---- statistics


def test_shares(spark):
    counts = frame(spark, "c string, k string, n bigint", ("US", "a", 3), ("US", "b", 1), ("BR", "a", 4))
    shares = stats.share_per_scope(counts, "c", "k", "n", "s")
    assert rows(shares) == [
        ("ALL", "a", 7, 0.875), ("ALL", "b", 1, 0.125), ("BR", "a", 4, 1.0), ("US", "a", 3, 0.75), ("US", "b", 1, 0.25),
    ]
    assert "SinglePartition" not in plan(shares) and "CartesianProduct" not in plan(shares)


def test_pivot(spark):
    df = frame(spark, "c string, k string", ("US", "Movie"), ("US", "Movie"), ("BR", "TV Show"), ("FR", "Movie"), ("FR", "TV Show"))
    out = stats.pivot_counts(df, "c", "k", {"Movie": "movies", "TV Show": "shows"}, "both")
    assert rows(out) == [("BR", None, 1, 1), ("FR", 1, 1, 2), ("US", 2, None, 2)]


def test_group_counts_of_null(spark):
    df = frame(spark, "k string", ("a",), (None,), (None,))
    assert rows(stats.group_by_count(df, "k")) == [("a", 1), (None, 0)]


# ---- enrichment


def test_merge_policies(spark):
    df = frame(spark, "id int, a string, b string", (1, "old", "old"), (2, "old", None), (3, "old", "old"))
    new = frame(spark, "id int, a string, b string, c int", (1, None, "new", 5), (2, "new", None, None), (2, "zzz", None, None))
    policy = {"a": enrich.NEW_FIRST, "b": enrich.NEW_ONLY, "c": enrich.NEW_FIRST}
    merged = enrich.merge_answers(df, new, "id", policy)
    assert rows(merged) == [(1, "old", "new", 5), (2, "new", None, None), (3, "old", None, None)]
    kept = enrich.merge_answers(df, new, "id", {"b": enrich.OLD_FIRST})
    assert rows(kept, "id", "b") == [(1, "old"), (2, None), (3, "old")]


def test_video_enrichment(spark):
    videos = frame(spark, "video_id string, is_scraped int, duration string", ("a", 0, None), ("b", 0, "x"), ("c", 1, "done"), ("d", -1, None))
    answers = frame(spark, "video_id string, duration string, caption string", ("a", "PT1M", "true"), ("c", "other", "true"))
    out = enrich.enrich_videos(videos, answers)
    assert rows(out) == [("a", 1, "PT1M", "true"), ("b", -1, "x", None), ("c", 1, "done", None), ("d", -1, None, None)]
    # Nothing is pending any more.
    assert rows(enrich.enrich_videos(out, answers)) == rows(out)


def test_missing_data(spark):
    df = frame(spark, "id string, key string", ("t1", None), ("t2", "C"), (None, None))
    answers = frame(spark, "id string, key string, bpm string", ("t1", "D", "120"), ("t3", "E", "1"))
    out = enrich.fill_missing_data(df, answers, "id", ["key", "bpm"])
    assert rows(out) == [("t1", "D", "120"), ("t2", "C", None), (None, None, None)]


def test_id_lookup(spark):
    titles = frame(spark, "show_id string, title string", ("s1", "Clash "), ("s2", "None"), ("s3", None))
    hits = frame(spark, "title string, position int, imdb_id string", ("clash", 2, "b"), ("CLASH", 1, "a"))
    assert rows(enrich.lookup_ids(titles, hits), "show_id", "imdb_id") == [("s1", "a"), ("s2", None), ("s3", None)]


def test_counted_dimensions_are_broadcast(spark, monkeypatch):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")  # as for a table whose size the planner does not know
    try:
        facts = spark.range(100).selectExpr("id", "if(id % 2 = 0, 7, id % 5) AS k")
        dimension = spark.createDataFrame([(7, "hot"), (1, "a"), (1, "b"), (None, "none")], "k long, name string")
        plain, counted = (joins.dimension_lookup(facts, dimension, "k", ["name"], counted=c) for c in (False, True))
        assert "BroadcastHashJoin" not in plan(plain) and "BroadcastHashJoin" in plan(counted) and "Exchange hashpartitioning" not in plan(counted)
        assert rows(plain) == rows(counted)
        monkeypatch.setattr(joins, "DIMENSION_ROWS", 3)
        assert "BroadcastHashJoin" not in plan(joins.dimension_lookup(facts, dimension, "k", ["name"], counted=True))
    finally:
        spark.conf.set(setting, before)
