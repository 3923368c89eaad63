"""Bloom filters, reads that skip, figures while writing, runs that go on, checkpoints that know when they are stale."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.operators import bloom, match, observed, quality
from reelsift.plans.resumable import EnrichmentRun
from reelsift.sources import writers


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    writers.create_database(spark, name, str(tmp_path / name))
    return name


def numbers(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("key"), F.col("id")).alias("k"))


def test_a_bloom_filter_misses_nothing_and_passes_little(spark):
    found = bloom.BloomFilter(numbers(spark, 0, 20_000), "k")
    assert found.n_keys == 20_000
    everything = numbers(spark, 0, 220_000)
    passed = found.may_hold(everything, "k")
    assert numbers(spark, 0, 20_000).join(passed, "k", "left_anti").isEmpty()
    others = passed.count() - 20_000
    assert 0.3 * found.error_rate < others / 200_000 < 2 * found.error_rate < 0.02
    assert "Exchange hashpartitioning" not in plan(passed) and passed.columns == ["k"]


def test_bloom_filters_of_odd_keys(spark):
    nulls = spark.createDataFrame([(None,), ("a",), ("a",), ("",)], "k string")
    found = bloom.BloomFilter(nulls, "k")
    assert found.n_keys == 2 and rows(found.may_hold(nulls, "k")) == [("",), ("a",), ("a",)]
    assert bloom.BloomFilter(nulls.limit(0), "k").may_hold(nulls, "k").count() == 0
    clash = nulls.withColumn("__bits", F.lit(1)).withColumn("word", F.lit(2))
    assert found.may_hold(clash.drop("__bits"), "k").columns == ["k", "word"]


def test_a_full_filter_passes_more_but_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_WORDS", 40)
    found = bloom.BloomFilter(numbers(spark, 0, 500), "k")
    assert found.words == 40 and found.may_hold(numbers(spark, 0, 500), "k").count() == 500


def test_membership_and_matches_beyond_what_is_sent(spark, monkeypatch):
    members, df = numbers(spark, 0, 300), numbers(spark, 200, 3000)
    assert rows(quality.keep_members(df, "k", members, prefilter=True)) == rows(quality.keep_members(df, "k", members))
    titles = spark.createDataFrame([(1, "the long night"), (2, "sunrise"), (3, "night of days"), (4, "absent words")], "show_id int, title string")
    texts = spark.createDataFrame([(k, f"word{k} the long night of days {'sunrise' if k % 3 else ''} tail{k}") for k in range(200)], "text_id int, body string")
    want = rows(match.match_titles(titles, texts, "title", "body", "text_id"), "show_id", "text_id")
    sizes = []
    plain = match.durable
    monkeypatch.setattr(match, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(match, "durable", lambda df: sizes.append(df) or plain(df))
    assert rows(match.match_titles(titles, texts, "title", "body", "text_id"), "show_id", "text_id") == want
    # What is shuffled of the texts' keys is what the titles have, within the filter's errors.
    keys = match.text_keys(texts, "body", ["text_id"], match.KINDS)
    mine = match.title_keys(titles.select(F.col("title").alias("__title")), "__title").select(F.explode("__keys").alias("__key")).distinct()
    passed = bloom.BloomFilter(mine, "__key").may_hold(keys, "__key")
    held = keys.join(mine, "__key", "left_semi").count()
    assert held <= passed.count() <= held + 0.05 * keys.count()


def rows_scanned(df):
    """Rows that came out of the parquet scans of a plan that has run."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if name.startswith("AdaptiveSparkPlan"):
            walk(node.executedPlan())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_clustered_reads_skip(spark, database, tmp_path):
    name = f"{database}.events"
    events = spark.range(40_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"), (F.col("id") * 7919 % 40_000).alias("user"), F.col("id"))
    table = writers.publish_clustered(events, name, ["day", "user"], "user", str(tmp_path / "e"), rows_per_page=100, distinct_keys=40_000)
    assert rows(table) == rows(events)
    day = table.where("day = date'2024-01-09'")
    assert day.count() == 1000 and rows_scanned(day) < 15_000
    lookup = spark.table(name).where("day = date'2024-01-09' AND user = 7919 * 8 % 40000")
    assert len(lookup.collect()) == 1 and rows_scanned(lookup) <= 300
    nobody = spark.table(name).where("user = 123456")  # out of every span
    assert rows_scanned(nobody) == 0
    again = writers.publish_clustered(events.where("id < 100"), name, "day", base_path=str(tmp_path / "e"))
    assert again.count() == 100


def test_a_bloom_filter_in_the_files_skips_lookups(spark, database, tmp_path):
    # Even numbers only, spread over all files: spans say nothing, the filters do.
    events = spark.range(20_000).select((F.col("id") % 20).alias("day"), (F.col("id") * 7919 % 20_000 * 2).alias("user"))
    with_filter = writers.publish_clustered(events, f"{database}.b", "day", "user", str(tmp_path / "b"), distinct_keys=20_000)
    without = writers.publish_clustered(events, f"{database}.n", "day", None, str(tmp_path / "n"))
    assert rows_scanned(without.where("user = 20001")) == 20_000
    assert rows_scanned(with_filter.where("user = 20001")) <= 10_000


def test_figures_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([("red", None, 1), (None, "blue", 0), ("rod", "red", 1)], "a string, b string, flag int")
    figures = observed.null_counts(["a", "b"]) | observed.pattern_counts(["a", "b"], "^r") | observed.flag_counts({"flagged": "flag"})
    runs = spark.sparkContext.accumulator(0)
    got = observed.write_observed(df, lambda d: d.write.parquet(str(tmp_path / "out")), figures)
    assert got == {
        "a_na": 1, "b_na": 1, "a_count": 2, "b_count": 1, "all_columns_match_count": 1, "any_column_match_count": 2, "flagged": 2, "share_of_flagged": pytest.approx(2 / 3)
    }
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3 and runs.value == 0
    one = observed.as_row(df, {"a_na": 1})
    assert rows(one) == [(1,)]
    text = plan(df.observe("seen", F.count("*")))
    assert "CollectMetrics" in text and len(re.findall("Scan|LocalTableScan", text)) == 1
    assert observed.write_observed(df, lambda d: d.write.parquet(str(tmp_path / "none")), {}) == {}
    empty = observed.write_observed(df.limit(0), lambda d: d.write.parquet(str(tmp_path / "empty")), observed.flag_counts({"flagged": "flag"}))
    assert empty == {"flagged": 0, "share_of_flagged": None}


class Service:
    def __init__(self, stop_after):
        self.stop_after, self.asked = stop_after, []

    def __call__(self, ids):
        if len(self.asked) == self.stop_after:
            raise ConnectionError
        self.asked.append(sorted(r.id for r in ids.collect()))
        return ids.withColumn("answer", F.col("id") * 10)


@pytest.mark.parametrize("stop", [0, 1, 2, 4])
def test_a_stopped_run_goes_on(spark, tmp_path, stop):
    pending, merged = spark.range(10).selectExpr("CASE WHEN id = 3 THEN NULL ELSE id END AS key").unionAll(spark.range(2).toDF("key")), []
    first, second = Service(stop), Service(99)
    for service in (first, second):
        run = EnrichmentRun(spark, "r", str(tmp_path))
        run.plan(pending, "key", 2)
        try:
            run.run(service, lambda answers: merged.extend(map(tuple, answers.collect())))
        except ConnectionError:
            assert service is first
        pending = spark.range(50, 60).toDF("key")  # what is planned stays planned
    asked = first.asked + second.asked
    assert sorted(sum(asked, [])) == [0, 1, 2, 4, 5, 6, 7, 8, 9] and all(len(ids) <= 2 for ids in asked)
    assert sorted(merged) == [(k, 10 * k) for k in (0, 1, 2, 4, 5, 6, 7, 8, 9)]
    assert EnrichmentRun(spark, "r", str(tmp_path)).run(second, merged.append) == 0


def test_a_run_that_ended_while_merging_asks_nothing_again(spark, tmp_path):
    run, service = EnrichmentRun(spark, "r", str(tmp_path)), Service(99)
    run.plan(spark.range(4), "id", 4)
    with pytest.raises(ZeroDivisionError):
        run.run(service, lambda answers: 1 / 0)
    assert run.progress() == {0: {"answered"}}
    merged = []
    assert run.run(service, lambda answers: merged.append(answers.count())) == 1
    assert merged == [4] and len(service.asked) == 1 and run.run(service, merged.append, most=1) == 0


def test_a_checkpoint_knows_when_it_is_stale(spark, database, tmp_path):
    path, table, built = str(tmp_path / "in"), f"{database}.c", []

    def saved(**arguments):
        rows_in = spark.read.parquet(path)
        build = lambda: built.append(1) or rows_in.withColumn("x", F.lit(len(built)))
        return rows(writers.checkpoint_or_build(spark, table, build, [rows_in], arguments, str(tmp_path / "base")))

    spark.range(2).coalesce(1).write.parquet(path)
    assert saved() == saved() == [(0, 1), (1, 1)]
    spark.range(2, 3).coalesce(1).write.mode("append").parquet(path)
    assert saved() == saved() == [(0, 2), (1, 2), (2, 2)]
    assert saved(k=1) == saved(k=1) == [(0, 3), (1, 3), (2, 3)]
    assert saved()[0] == (0, 4)
    # A table saved without a signature is not trusted.
    writers.save_checkpoint(spark.range(1).withColumn("x", F.lit(9)), f"{database}.d", str(tmp_path / "base"))
    assert rows(writers.checkpoint_or_build(spark, f"{database}.d", lambda: spark.range(1).withColumn("x", F.lit(10)), [])) == [(0, 10)]
