"""Time the plain form of a few operators (cross join, row-at-a-time UDF, join before aggregation) next to ours.

python tools/forms.py [data folder]
"""

from __future__ import annotations

import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import types as T  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reelsift.functions import rules  # noqa: E402
from reelsift.lookups import CATALOGUE_GENRE_RULES, MUSIC_GENRE_RULES  # noqa: E402
from reelsift.operators import match  # noqa: E402
from reelsift.plans import marts  # noqa: E402
from reelsift.session import build_session  # noqa: E402
from workload.joining import page_titles  # noqa: E402
from workload.marts import order_videos, part_tags, trending  # noqa: E402
from workload.registry import Tables  # noqa: E402


def seconds(build, repeats: int = 3) -> float:
    runs = []
    for _ in range(repeats + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        runs.append(time.perf_counter() - start)
        if runs[0] > 60:
            return runs[0]
    return statistics.median(runs[1:])


def plain_title_match(t):
    whole_words = F.udf(lambda text, title: bool(re.search(rf"\b{re.escape(title)}\b", text, re.IGNORECASE)), T.BooleanType())
    titles = page_titles(t).where(F.length("title") > 5)
    pairs = titles.crossJoin(t.documents.select("doc_id", "text"))
    return pairs.where(F.lower("text").contains(F.lower("title"))).where(whole_words("text", "title"))


def plain_top_tags(t):
    bridge, tags = part_tags(t)
    trending(t, "l_partkey").join(bridge, "video_id").join(tags, "tag_id").createOrReplaceTempView("tagged_rows")
    return t.spark.sql(
        """SELECT * FROM (
             SELECT *, row_number() OVER (PARTITION BY country_dataset ORDER BY n DESC, tag) AS place FROM (
               SELECT tag, country_dataset, count(*) AS n, avg(view_count), avg(likes), avg(try_divide(likes, view_count))
               FROM tagged_rows WHERE view_count > 1000000 AND tag <> 'red' GROUP BY tag, country_dataset))
           WHERE place <= 10"""
    )


def plain_distribution(t):
    trending(t, "l_orderkey").join(order_videos(t), "video_id", "left").createOrReplaceTempView("categorised_rows")
    return t.spark.sql(
        """WITH counted AS (
             SELECT country_dataset, category_name, count(*) AS n FROM categorised_rows
             GROUP BY country_dataset, category_name UNION ALL
             SELECT 'ALL', category_name, count(*) FROM categorised_rows GROUP BY category_name)
           SELECT *, n / sum(n) OVER (PARTITION BY country_dataset) AS share FROM counted"""
    )


def genre_names(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws(" ", "p_name", "p_type", "l_returnflag").alias("genre")
    )


def plain_genres(t):
    ladder = [(re.compile(rule.pattern, re.IGNORECASE), rule.label) for rule in MUSIC_GENRE_RULES]
    mapped = F.udf(lambda genre: next((label for p, label in ladder if p.search(genre)), "others"), T.StringType())
    return genre_names(t).select(mapped("genre"))


def plain_cascade(t):
    value = F.col("genre")
    for pattern, label in CATALOGUE_GENRE_RULES:
        value = F.regexp_replace(value, f"(?i){pattern}", label)
    return genre_names(t).select(value)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("forms", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    cases = {
        "title match": (plain_title_match, lambda t: match.match_titles(page_titles(t), t.documents.select("doc_id", "text"), "title", "text", "doc_id")),
        "top tags per country": (plain_top_tags, lambda t: marts.top_tags_per_country(trending(t, "l_partkey"), *part_tags(t), k=10, exclude="red")),
        "category distribution": (plain_distribution, lambda t: marts.category_distribution(trending(t, "l_orderkey"), order_videos(t))),
        "first-match ladder": (plain_genres, lambda t: genre_names(t).select(rules.map_genre("genre"))),
        "first-match ladder, per distinct": (plain_genres, lambda t: rules.apply_per_distinct(genre_names(t), "genre", "label", rules.map_genre)),
        "cascade": (plain_cascade, lambda t: genre_names(t).select(rules.cascade("genre", CATALOGUE_GENRE_RULES))),
        "cascade, per distinct": (plain_cascade, lambda t: rules.apply_per_distinct(genre_names(t), "genre", "label", lambda c: rules.cascade(c, CATALOGUE_GENRE_RULES))),
    }
    for name, (plain, ours) in cases.items():
        mine = seconds(lambda: ours(t))
        theirs = seconds(lambda: plain(t), 1)
        print(f"| {name} | {theirs:.2f} | {mine:.2f} | {theirs / mine:.1f} |", flush=True)


if __name__ == "__main__":
    main()
