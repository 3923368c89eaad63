from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from reelsift import lookups
from reelsift.functions import dates, landed, money, rules, text, values
from reelsift.lookups import Rule


def one(spark, column, **inputs):
    """Value of a column expression over one row of strings."""
    schema = ", ".join(f"`{name}` string" for name in inputs)
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column).collect()[0][0]


@pytest.mark.parametrize("raw, bare", [('""a"b"', 'a"b'), ("a", "a"), ('"""', ""), (None, None), (' "a"', ' "a')])
def test_outer_quotes(spark, raw, bare):
    assert one(spark, text.remove_outer_quotes("c"), c=raw) == bare


@pytest.mark.parametrize("raw, bare", [(' "India" ', "India"), ('""x""', '"x"'), ("France", "France"), (None, None)])
def test_field_quotes(spark, raw, bare):
    df = spark.createDataFrame([(raw,)], "countries string")
    assert rows(text.remove_quotes_from_country(df)) == [(bare,)]


def test_leading_comma(spark):
    assert one(spark, text.strip_leading_comma("c"), c=", France, Spain") == "France, Spain"
    assert one(spark, text.strip_leading_comma("c"), c=",France") == ",France"


def test_id_prefix_and_truncation(spark):
    df = spark.createDataFrame([("s12",), ("x1",), (None,)], "show_id string")
    assert rows(text.change_id_prefix(df, "nflx")) == [("nflx12",), ("x1",), (None,)]
    assert rows(text.truncate_string_columns(df, "show_id", 1, 1)) == [("s",), ("x",), (None,)]
    assert rows(text.truncate_string_columns(df, ["show_id"], 2)) == [("1",), ("12",), (None,)]


def test_keyword_flag(spark):
    flag = text.keyword_flag("g", ["Animation", "Anime Series"])
    assert one(spark, flag, g="Anime Series, Comedies") == "yes"
    assert one(spark, flag, g="Dramas") == "no"
    assert one(spark, flag, g=None) == "no"


def test_replacements_reach_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert rows(values.replace_value_in_column(df, "c", None, "z")) == [("a",), ("z",)]
    assert rows(values.replace_value_in_column(df, "c", "a", None)) == [(None,), (None,)]


@pytest.mark.parametrize("size", [3, 300])
def test_mapping_default(spark, size):
    mapping = {str(i): i for i in range(size)}
    df = spark.createDataFrame([("1",), ("x",), (None,)], "c string")
    assert rows(values.map_column_values(df, mapping, "c", "n", -1)) == [("1", 1), ("x", -1), (None, -1)]
    assert rows(values.map_column_values(df, mapping, "c")) == [(1,), (None,), (None,)]


def test_text_booleans(spark):
    flag = values.string_boolean("c")
    assert [one(spark, flag, c=c) for c in ("true", "False", "x", None)] == [1, 0, None, None]


def test_lists_to_text(spark):
    df = spark.createDataFrame(
        [([("A",), (None,), ("B",)],), ([],), (None,)], "people array<struct<name: string>>"
    )
    assert [r[0] for r in df.select(values.names_text("people")).collect()] == ["A, B", None, None]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "a bigint, b bigint")
    assert [r[0] for r in df.select(values.ratio("a", "b")).collect()] == [0.25, None, None]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2020-01-02", date(2020, 1, 2)), ("2020", date(2020, 1, 1)), ("15 Jun 2012 (USA)", date(2012, 6, 15)),
        ("Jun 2012", date(2012, 6, 1)), ("junk", None), ("2020-13-45", None), (None, None),
    ],
)
def test_release_dates(spark, raw, expected):
    assert one(spark, dates.release_date("c"), c=raw) == expected


def test_long_dates(spark):
    assert one(spark, dates.long_date("c"), c="September 9, 2019") == date(2019, 9, 9)
    assert one(spark, dates.long_date("c"), c="9/9/2019") is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("PT4M13S", "0.00:04:13"), ("P1DT2H3M4S", "1.02:03:04"), ("P1D", None), ("PT100H", "0.100:00:00"), ("", None),
        (None, None), ("PT", "0.00:00:00"), ("PT007M", "0.00:07:00"), ("PT99999999999999999999S", "0.00:00:99999999999999999999"),
        ("xPT1M", None), ("PT1Mtail", "0.00:01:00"), ("P1WT5S", None),
    ],
)
def test_iso_durations(spark, raw, expected):
    assert one(spark, dates.iso8601_to_time("c"), c=raw) == expected


def test_durations_take_few_passes_over_the_text(spark):
    text = plan(spark.createDataFrame([("P1DT2H",)], "c string").select(dates.iso8601_to_time("c").alias("t")))
    assert text.count("regexp_") + text.count("RLIKE") <= 3
    for raw, expected in [("P0012DT007H0S", "12.07:00:00"), ("PT100H5Mx\n.", "0.100:05:00"), ("PT", "0.00:00:00"), ("PDT1H", None), ("1.02:03:04", None)]:
        assert one(spark, dates.iso8601_to_time("c"), c=raw) == expected


def test_local_times(spark):
    summer, winter = datetime(2024, 7, 1, 12), datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [(summer, "US"), (winter, "US"), (summer, "IN"), (summer, "XX"), (None, "US"), (summer, None)],
        "utc timestamp_ntz, country string",
    )
    local = [r[0] for r in dates.convert_to_local_time(df, "utc", "country", "local").select("local").collect()]
    assert local == [datetime(2024, 7, 1, 8), datetime(2024, 1, 1, 7), datetime(2024, 7, 1, 17, 30), summer, None, summer]


def test_duration_split_and_years(spark):
    df = spark.createDataFrame([("Movie", "90 min"), ("TV Show", "2 Seasons"), ("Movie", None), ("Movie", "x")], "category string, duration string")
    assert [tuple(r) for r in dates.split_duration(df).collect()] == [
        ("Movie", 90, None), ("TV Show", None, 2), ("Movie", None, None), ("Movie", None, None),
    ]
    years = spark.createDataFrame([("2011-2019",), ("2011-",), ("2011",), (None,)], "series_years string")
    assert [tuple(r) for r in dates.split_series_years(years).collect()] == [(2011, 2019), (2011, None), (2011, None), (None, None)]


def test_truncation_keeps_the_type(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-06 07:08:09' AS a, DATE'2024-05-06' AS b")
    out = df.select(dates.truncate_time(df, "a", "month").alias("a"), dates.truncate_time(df, "b", "year").alias("b"))
    assert out.dtypes == [("a", "timestamp_ntz"), ("b", "date")]
    assert rows(out) == [(datetime(2024, 5, 1), date(2024, 1, 1))]


BOX = "{Budget=$40,000,000 (estimated), Opening Weekend United States=US$1,000, 02 Jan 2020, Cumulative Worldwide Gross=INR1,000}"


def test_box_office_fields(spark):
    df = spark.createDataFrame([(BOX,), (None,), ("{Budget=$5}",)], "box_office string")
    out = money.extract_box_office_data(df.withColumn("box_office", money.strip_braces("box_office")))
    assert [tuple(r)[1:] for r in out.collect()] == [
        (
            "Budget=$40,000,000 (estimated)", "Opening Weekend United States=US$1,000, 02 Jan 2020",
            "Cumulative Worldwide Gross=INR1,000",
        ),
        (None, None, None),
        (None, None, None),
    ]


def test_box_office_to_eur(spark):
    df = spark.createDataFrame([(BOX,), (None,), ("{Cumulative Worldwide Gross=ZZZ7}",)], "box_office string")
    out = [tuple(r) for r in money.box_office_to_eur(df).collect()]
    # "US$" has no rate.
    assert out == [(round(40_000_000 / 1.1082), None, round(1000 / 92.8401)), (None, None, None), (None, None, None)]


@pytest.mark.parametrize("field", list(money.BOX_OFFICE_FIELDS))
@pytest.mark.parametrize("amount", ["$40,000", "INR1,000", "US$12", "US $7", "€5", "Ab$1,5", "ABCD9", " $,3", "fr.8"])
def test_tokens_behind_the_label_are_those_of_the_whole_field(spark, field, amount):
    label = {"budget": "Budget={} (estimated)", "opening_weekend": "Opening Weekend US AB={}, 02 Jan 2020", "cumulative_worldwide_gross": "Cumulative Worldwide Gross={}"}[field]
    df = spark.createDataFrame([(label.format(amount),)], "c string")
    behind = F.regexp_extract("c", money.BOX_OFFICE_FIELDS[field], 1)
    whole = F.regexp_extract("c", money.BOX_OFFICE_FIELDS[field], 0)
    row = df.select(money.money_token(behind, field).alias("a"), money.money_token(whole, field).alias("b")).collect()[0]
    assert row.a == row.b


def test_rates_take_aliases(spark):
    rates = money.rates_table(spark, {"US$": 2, "X": None})
    df = spark.createDataFrame([("US$", 4.0), ("X", 1.0), ("?", 1.0)], "unit string, amount double")
    assert [r.eur for r in money.convert_to_eur(df, "unit", "amount", "eur", rates).collect()] == [2.0, None, None]


RULES = [Rule(".*ab.*", "one"), Rule("b+", "two"), Rule(r"\bc\b|one", "th$ee")]


def test_first_and_last_match(spark):
    first, last = rules.first_match("c", RULES, "none"), rules.last_match("c", RULES)
    cases = {"xABx": ("one", "xABx"), "xabx": ("one", "two"), "bb c": ("two", "th$ee"), "zz": ("none", "zz"), None: (None, None)}
    for value, expected in cases.items():
        assert (one(spark, first, c=value), one(spark, last, c=value)) == expected


def test_cascade_sees_earlier_labels(spark):
    cascade = rules.cascade("c", RULES)
    assert one(spark, cascade, c="xABx") == "th$ee"
    assert one(spark, cascade, c="zbbz c") == "ztwoz th$ee"
    assert one(spark, cascade, c="line ab\nother") == "th$ee\nother"


@pytest.mark.parametrize("value", ["a\nxabx\n\nab", "ab", "\n", "x\r\nab y\rz", "AB b"])
def test_anchoring_keeps_the_meaning(spark, value):
    plainly = F.regexp_replace("c", "(?i).*ab.*|.*q.*", "L")
    assert one(spark, rules.cascade("c", [Rule(".*ab.*|.*q.*", "L")]), c=value) == one(spark, plainly, c=value)


def test_genre_rules(spark):
    genre = rules.map_genre("c")
    names = ["Trap Metal", "trap queen", "hip hop", "Pop RAP", "polka", "hardcore", None]
    assert [one(spark, genre, c=n) for n in names] == ["metal", "trap", "rap", "rap", "others", "electronic", None]


def test_catalogue_rules(spark):
    label = rules.cascade("c", lookups.CATALOGUE_GENRE_RULES)
    cases = {
        "Fantasy": "Sci-Fi & Fantasy", "Dramas, International Movies": "Drama", "Action-Adventure": "Adventure",
        "Anime Series, Comedies": "Anime", "polka": "polka", None: None,
    }
    for value, expected in cases.items():
        assert one(spark, label, c=value) == expected


def test_tag_rules(spark):
    tags = {"funny gaming news": "news", "minecraft": "minecraft", "kpop": "k-pop", "unheard": "unheard", "podcast": "podcast", "podcasts": "podcast"}
    for value, expected in tags.items():
        assert one(spark, rules.last_match("c", lookups.TAG_RULES), c=value) == expected
    assert one(spark, rules.last_match("c", lookups.TAG_RULES), c="sciences") == "sciencce"
    assert one(spark, rules.last_match("c", lookups.repaired_tag_rules()), c="my interview") == "interview"


def test_per_distinct_equals_direct(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["xabx", "b", None, "zz", "b"])], "i int, c string")
    rule = lambda c: rules.first_match(c, RULES, "none")
    direct = df.withColumn("label", rule("c"))
    assert rows(rules.apply_per_distinct(df, "c", "label", rule)) == rows(direct)


def test_no_python_in_the_expressions(spark):
    df = spark.createDataFrame([("x", datetime(2024, 1, 1), "US")], "c string, ts timestamp_ntz, k string")
    out = df.select(
        dates.iso8601_to_time("c"), dates.to_local_time(F.col("ts"), F.col("k")), rules.map_genre("c"),
        rules.cascade("c", lookups.CATALOGUE_GENRE_RULES),
    )
    assert "BatchEvalPython" not in plan(out) and "ArrowEvalPython" not in plan(out)


def test_video_answers(spark):
    full = '{"id": "v1", "snippet": {"tags": ["a"], "defaultLanguage": "en"}, "contentDetails": {"duration": "PT1M", "caption": "true", "licensedContent": true, "regionRestriction": {"blocked": ["US"]}, "contentRating": {}}}'
    df = spark.createDataFrame([(full,), ('{"id": "v2"}',), ("not json",)], "response string")
    out = [tuple(r) for r in landed.video_columns(df).collect()]
    assert out[0] == ("v1", ["a"], "en", "PT1M", "true", True, {"blocked": ["US"]}, {})
    assert out[1] == ("v2",) + (None,) * 7
    assert out[2] == (None,) * 8


def test_title_answers(spark):
    body = '{"rating": 7.5, "votes": 12, "color": ["Color", "x"], "top 250 rank": 3, "cast": [{"name": "A"}, {"id": 1}], "languages": []}'
    df = spark.createDataFrame([("tt1", body)], "imdb_id string, response string")
    out = landed.title_columns(df).collect()[0]
    assert (out.rating, out.votes, out.color, out.top_250, out["cast"], out.languages) == (7.5, 12, "Yes", "Yes", "A", None)


def test_search_hits(spark):
    assert one(spark, landed.top_search_hit("c"), c='[{"movieID": "1"}, {"movieID": "2"}]') == "1"
    assert one(spark, landed.top_search_hit("c"), c="[]") is None


def test_mapping_types_do_not_depend_on_its_size(spark):
    df = spark.range(3).withColumnRenamed("id", "c")
    results = [values.map_column_values(df, {i: i for i in range(n)}, "c", "n", -1) for n in (1, 100, 101)]
    assert len({str(r.schema) for r in results}) == 1
    assert rows(results[1]) == rows(results[2])
