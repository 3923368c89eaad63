"""Row filters and data-quality counts."""

from pyspark.sql import functions as F

from reelsift import lookups
from reelsift.functions.values import map_literal
from reelsift.operators import joins, observed, quality
from reelsift.operators.dedup import display_duplicates
from reelsift.operators.enrich import pending_rows
from reelsift.operators.ranking import sort_rows, top_n
from reelsift.operators.stats import group_by_count
from reelsift.sources import writers
from workload.registry import REGISTRY, query

LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"


def labelled(t):
    return t.documents.join(t.labels, "doc_id", "left")


@query("w1_missing_rows", f"SELECT d.doc_id, lang, quality FROM {LABELLED} WHERE quality IS NULL OR toxic IS NULL")
def _(t):
    return quality.select_rows_with_missing_values(labelled(t), ["quality", "toxic"]).select("doc_id", "lang", "quality")


@query(
    "w2_null_counts",
    f"""SELECT count(*) FILTER (WHERE quality IS NULL) AS quality_na, count(*) FILTER (WHERE toxic IS NULL) AS toxic_na,
        count(*) FILTER (WHERE text IS NULL) AS text_na FROM {LABELLED}""",
)
def _(t):
    return quality.count_na(labelled(t), ["quality", "toxic", "text"])


@query("w2_while_writing", REGISTRY["w2_null_counts"].sql)
def _(t):
    rows, columns = labelled(t), ["quality", "toxic", "text"]
    figures = observed.write_observed(rows, lambda df: df.write.parquet(t.scratch()), observed.null_counts(columns))
    return observed.as_row(rows, figures)


@query("e1_pending_rows", f"SELECT d.doc_id, source FROM {LABELLED} WHERE quality IS NULL OR n_chars = 0")
def _(t):
    return pending_rows(labelled(t), ["quality"], flag="n_chars", value=0).select("doc_id", "source")


ALL_TEXTS = """SELECT 'd' AS kind, text FROM documents UNION ALL SELECT 'c', text FROM conversations
    UNION ALL SELECT 'b', text FROM benchmark"""


def all_texts(t):
    parts = [("d", t.documents), ("c", t.conversations), ("b", t.benchmark)]
    frames = [df.select(F.lit(kind).alias("kind"), "text") for kind, df in parts]
    return frames[0].union(frames[1]).union(frames[2])


@query(
    "w3_readable_texts",
    rf"SELECT kind, md5(text) AS digest FROM ({ALL_TEXTS}) WHERE NOT regexp_matches(text, '^[�\W]+$')",
)
def _(t):
    kept = quality.drop_missing_character(all_texts(t), "text", ascii_words=True)
    return kept.select("kind", F.md5("text").alias("digest"))


@query(
    "w3_unicode_words",
    r"""SELECT l_returnflag, l_linestatus, count(*) AS kept FROM lineitem
        WHERE NOT regexp_matches(translate(l_returnflag || l_linestatus, 'AF', '�?'), '^[^\p{L}\p{N}]+$')
        GROUP BY ALL""",
)
def _(t):
    marked = F.translate(F.concat("l_returnflag", "l_linestatus"), "AF", "�?")
    kept = quality.drop_missing_character(t.lineitem.withColumn("mark", marked), ["mark"])
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("kept"))


@query(
    "w3_any_missing_character",
    "SELECT p_partkey FROM part WHERE NOT regexp_matches(translate(p_name, 'z', '�'), '�+')",
)
def _(t):
    marked = t.part.withColumn("mark", F.translate("p_name", "z", "�"))
    return quality.drop_missing_character(marked, "mark", full_string=False).select("p_partkey")


@query(
    "w4_pattern_counts",
    """SELECT count(*) FILTER (WHERE regexp_matches(p_name, 'l+|(?i)ro')) AS p_name_count,
        count(*) FILTER (WHERE regexp_matches(p_type, 'l+|(?i)ro')) AS p_type_count,
        count(*) FILTER (WHERE regexp_matches(p_name, 'l+|(?i)ro') AND regexp_matches(p_type, 'l+|(?i)ro'))
            AS all_columns_match_count,
        count(*) FILTER (WHERE regexp_matches(p_name, 'l+|(?i)ro') OR regexp_matches(p_type, 'l+|(?i)ro'))
            AS any_column_match_count FROM part""",
)
def _(t):
    return quality.regexp_match_count(t.part, ["p_name", "p_type"], "l+|(?i)ro")


@query("w4_while_writing", REGISTRY["w4_pattern_counts"].sql)
def _(t):
    figures = observed.pattern_counts(["p_name", "p_type"], "l+|(?i)ro")
    return observed.as_row(t.part, observed.write_observed(t.part, lambda df: writers.write_csv(df, t.scratch()), figures))


SHAPES = ["^red", "rod$", "gi.mo"]


@query("w5_any_pattern", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^red|rod$|gi.mo')")
def _(t):
    return quality.filter_with_regex_list(t.part, "p_name", SHAPES).select("p_partkey", "p_name")


@query("w5_no_pattern", "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^red|rod$|gi.mo')")
def _(t):
    return quality.filter_with_regex_list(t.part, "p_name", SHAPES, reverse_match=True).select("p_partkey", "p_name")


@query("w6_accented", "SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[À-ÿ]|[Ѐ-ӿ]')")
def _(t):
    return quality.filter_non_english_values(t.documents, ["[À-ÿ]", "[Ѐ-ӿ]"], column="text").select("doc_id", "lang")


@query("w6_plain", "SELECT doc_id, lang FROM documents WHERE NOT regexp_matches(text, '[À-ÿ]|[Ѐ-ӿ]')")
def _(t):
    kept = quality.filter_non_english_values(t.documents, ["[À-ÿ]", "[Ѐ-ӿ]"], exclude_non_english=True, column="text")
    return kept.select("doc_id", "lang")


SCRIPTS = """(SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'ニュース ' WHEN 1 THEN 'أخبار ' WHEN 2 THEN '뉴스 ' WHEN 3 THEN '新闻 ' WHEN 4 THEN 'समाचार ' WHEN 5 THEN 'ข่าว '
    WHEN 6 THEN 'Новости ' ELSE 'Éà ' END || page_id AS title FROM pages)"""


def titles_in_scripts(t):
    words = {0: "ニュース ", 1: "أخبار ", 2: "뉴스 ", 3: "新闻 ", 4: "समाचार ", 5: "ข่าว ", 6: "Новости ", 7: "Éà "}
    return t.pages.select("page_id", F.concat(map_literal(words)[(F.col("page_id") % 8).cast("int")], "page_id").alias("title"))


@query("w6_default_scripts", f"SELECT page_id, title FROM {SCRIPTS} WHERE page_id % 8 < 6")
def _(t):
    return quality.filter_non_english_values(titles_in_scripts(t))


@query("w6_default_scripts_and_cyrillic", f"SELECT page_id, title FROM {SCRIPTS} WHERE page_id % 8 = 7")
def _(t):
    return quality.filter_non_english_values(titles_in_scripts(t), lookups.NON_LATIN_AND_CYRILLIC_BLOCKS, exclude_non_english=True)


@query(
    "w7_prefix_removed",
    """SELECT p_partkey, p_name FROM part
       WHERE NOT (starts_with(p_name, 'red ') OR starts_with(p_name, 'hot') OR starts_with(p_name, 'blue b'))""",
)
def _(t):
    return quality.remove_values_by_prefix(t.part, "p_name", ["red ", "hot", "blue b"]).select("p_partkey", "p_name")


@query(
    "w8_date_range",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate <= TIMESTAMP '1998-02-28'""",
)
def _(t):
    return quality.filter_date_range(t.orders, "o_orderdate", "1997-03-01", "1998-02-28").select("o_orderkey", "o_orderdate")


@query("w9_year", "SELECT event_id, ts FROM events WHERE year(ts) = 2024")
def _(t):
    return quality.filter_date_year(t.events, "ts", 2024).select("event_id", "ts")


@query(
    "w10_minimum_or_null",
    """SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0.0) AS cut FROM lineitem
       WHERE nullif(l_discount, 0.0) >= 0.08 OR nullif(l_discount, 0.0) IS NULL""",
)
def _(t):
    cut = t.lineitem.withColumn("cut", F.nullif("l_discount", F.lit(0.0)))
    return quality.keep_at_least(cut, "cut", 0.08).select("l_orderkey", "l_linenumber", "l_partkey", "cut")


@query(
    "w11_before_and_after",
    """SELECT p_brand, count(*) AS videos_count FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_extendedprice > 50000 AND p_type <> 'PROMO' GROUP BY p_brand HAVING count(*) > 100""",
)
def _(t):
    parts = t.part.where("p_type <> 'PROMO'").withColumnRenamed("p_partkey", "l_partkey")
    rows = joins.dimension_lookup(t.lineitem.where("l_extendedprice > 50000"), parts, "l_partkey", ["p_brand"], "inner")
    counts = group_by_count(rows, "p_brand").withColumnRenamed("p_brand_count", "videos_count")
    return quality.keep_at_least(counts, "videos_count", 101)


@query(
    "w12_keyword_filter",
    r"""SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'than')
        AND NOT regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(heat|are than|été|ÉLLE|onred)($|[^\p{L}\p{N}_])')
        AND lower(lang) NOT IN ('es')""",
)
def _(t):
    condition = quality.trailer_condition(
        F.col("text"), F.col("lang"), "than", ["heat", "are than", "été", "ÉLLE", "onred"], ("ES",)
    )
    return t.documents.where(condition).select("doc_id", "lang")


COMMON_NAMES = "SELECT p_name FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 20"


def common_names(t):
    counted = group_by_count(t.part, "p_name")
    return top_n(counted, [F.col("p_name_count").desc(), F.col("p_name")], 20).select("p_name")


@query("w13_members", f"SELECT p_partkey, p_name FROM part WHERE p_name IN ({COMMON_NAMES})")
def _(t):
    return quality.keep_members(t.part, "p_name", common_names(t)).select("p_partkey", "p_name")


@query("w13_members_by_bloom", REGISTRY["w13_members"].sql)
def _(t):
    return quality.keep_members(t.part, "p_name", common_names(t), prefilter=True).select("p_partkey", "p_name")


@query("w13_others", f"SELECT p_partkey, p_name FROM part WHERE p_name NOT IN ({COMMON_NAMES})")
def _(t):
    return quality.drop_members(t.part, "p_name", common_names(t)).select("p_partkey", "p_name")


@query(
    "w13_flags",
    f"SELECT p_partkey, CASE WHEN p_name IN ({COMMON_NAMES}) THEN 1 ELSE 0 END AS is_common FROM part",
)
def _(t):
    return quality.flag_members(t.part, "p_name", common_names(t), "is_common").select("p_partkey", "is_common")


@query(
    "n9_top_names",
    "SELECT p_name, count(*) AS p_name_count FROM part GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 20",
)
def _(t):
    return top_n(group_by_count(t.part, "p_name"), [F.col("p_name_count").desc(), F.col("p_name")], 20)


@query("n8_sorted", "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey ORDER BY orders DESC, o_custkey")
def _(t):
    counted = t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return sort_rows(counted, [F.col("orders").desc(), F.col("o_custkey")])


@query("a12_duplicates", "SELECT text, count(*) AS count FROM documents GROUP BY text HAVING count(*) > 1")
def _(t):
    return display_duplicates(t.documents, "text")
