import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift.operators import match

TITLES = [
    "#Alive", "Mamma Mia!", "The Office", "a b", "x", "Été", "#x", "x!", "?!", "a?!b", "the the", "C++", "R\\Eal", "1917",
    "naïve_café", "the", "office trailer", "ß", "...", "Ünder 2",
]
TEXTS = [
    "the office trailer", "theofficetrailer", "Office the", "THE OFFICE", "the  office", "watch x#alive now", "#alive", "x#alive",
    "mamma mia!", "mamma mia!b", "a b a b", "a b", "ab", "cet été là", "l'été", "étés", "a?!b", "a ?! b", "yes?!no", "c++", "c++x",
    "r\\eal", "in 1917.", "19170", "my naïve_café", "the the the", "", "ß", "a...b", "a..b", "ünder 2 ünder", None,
]


def found(title, text):
    """The literal title between word boundaries, ignoring case."""
    return bool(re.findall(rf"\b{re.escape(title)}\b", text, re.IGNORECASE))


def expected(titles, texts, min_length=1):
    return sorted(
        ((t, i) for t in titles if len(t) >= min_length for i, x in enumerate(texts) if x is not None and found(t, x)), key=repr
    )


def frames(spark, titles, texts):
    return (
        spark.createDataFrame([(t,) for t in titles], "title string"),
        spark.createDataFrame(list(enumerate(texts)), "text_id int, text string"),
    )


@pytest.mark.parametrize("inline", [True, False])
def test_equals_brute_force(spark, inline):
    left, right = frames(spark, TITLES, TEXTS)
    out = match.match_titles(left, right, "title", "text", "text_id", min_length=1, inline_text=inline)
    assert rows(out, "title", "text_id") == expected(TITLES, TEXTS)


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", "é", "A", " ", " ", "!", "-", "_", "1"]
    make = lambda n: "".join(rng.choice(alphabet) for _ in range(n))
    titles = sorted({make(rng.randint(1, 6)) for _ in range(150)})
    texts = [make(rng.randint(0, 60)) for _ in range(150)]
    left, right = frames(spark, titles, texts)
    out = match.match_titles(left, right, "title", "text", "text_id", min_length=1, salts=3)
    assert rows(out, "title", "text_id") == expected(titles, texts)


def test_repeated_titles_and_short_ones(spark):
    titles = ["the office", "the office", "The Office", "x"]
    left, right = frames(spark, titles, TEXTS)
    out = match.match_titles(left, right, "title", "text", "text_id")
    assert rows(out, "title", "text_id") == expected(titles, TEXTS, 6)
    with pytest.raises(ValueError):
        match.match_titles(left, right, "title", "text", "text_id", min_length=0)


def test_column_pattern(spark):
    pairs = [(t, x) for t in TITLES for x in TEXTS if x is not None]
    df = spark.createDataFrame(pairs, "title string, text string")
    out = df.withColumn("hit", match.exact_match(F.col("text"), F.col("title"))).collect()
    assert [r.hit for r in out] == [found(t, x) for t, x in pairs]


def test_no_nested_loop(spark):
    left, right = frames(spark, TITLES, TEXTS)
    text = plan(match.match_titles(left, right, "title", "text", "text_id"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_hot_key_is_spread(spark):
    left = spark.createDataFrame([("hot title",)], "title string")
    right = spark.range(500).select("id", F.concat(F.lit("a hot title "), F.col("id").cast("string")).alias("text"))
    assert match.match_titles(left, right, "title", "text", "id").count() == 500


def test_texts_with_the_pairs_of_a_title_alone_are_not_proposed(spark, monkeypatch):
    written, write = [], match.durable

    def count(df):
        written.append((df.columns, df.count()))
        return write(df)

    monkeypatch.setattr(match, "durable", count)
    left = spark.createDataFrame([("the office trailer",), ("two words",), ("single",)], "title string")
    right = spark.range(50).select("id", F.lit("The office, an office trailer").alias("text"))
    right = right.unionByName(spark.createDataFrame([(50, "see THE office Trailer"), (51, "two  words, two words"), (52, "a Single one")], "id long, text string"))
    out = match.match_titles(left, right, "title", "text", "id")
    assert rows(out, "title", "id") == [("single", 52), ("the office trailer", 50), ("two words", 51)]
    assert [n for columns, n in written if columns == ["__key", "id"]] == [3]


def test_best_per_key(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, None)], "k string, id int, m int")
    assert rows(match.best_per_key(df, "k", "m"), "k", "id") == [("a", 1), ("a", 2)]
    assert rows(match.best_per_key(df, "k", "m", ties="one", tie_breakers=["id"]), "k", "id") == [("a", 1)]
    with pytest.raises(ValueError):
        match.best_per_key(df, "k", "m", ties="some")


def test_no_titles_or_no_texts(spark):
    left, right = frames(spark, TITLES, TEXTS)
    assert match.match_titles(left.where("false"), right, "title", "text", "text_id").count() == 0
    assert match.match_titles(left, right.where("false"), "title", "text", "text_id").count() == 0


def test_shuffled_keys_equal_broadcast_keys(spark, monkeypatch):
    monkeypatch.setattr(match, "BROADCAST_ROWS", -1)
    left, right = frames(spark, TITLES, TEXTS)
    out = match.match_titles(left, right, "title", "text", "text_id", min_length=1)
    assert rows(out, "title", "text_id") == expected(TITLES, TEXTS)
