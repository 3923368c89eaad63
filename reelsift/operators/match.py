"""Whole-word title matching by an index of words that follow each other, and the best match per title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.operators.bloom import BloomFilter
from reelsift.operators.dedup import drop_duplicates_by_ordered_partition
from reelsift.operators.joins import BROADCAST_ROWS
from reelsift.session import durable

WORD = r"[\p{L}\p{N}_]"
WORDS = rf"{WORD}+"
# What separates two words, with both of them next to it.
INNER_GAPS = rf"(?<={WORD})[^\p{{L}}\p{{N}}_]+(?={WORD})"
KINDS = ("triple", "pair", "word", "gap")


def whole_word_pattern(title: Column) -> Column:
    """Regex that finds the title, taken literally, between word boundaries.

    An end of the title that is a word character must not touch another one in the text; any other
    end must touch one. The literal stands first, so that most positions fail on one character.
    """
    literal = F.concat(F.lit("\\Q"), F.replace(title, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    after = F.when(title.rlike(WORD + "$"), f"(?!{WORD})").otherwise(f"(?={WORD})")
    before = F.when(title.rlike("^" + WORD), f"(?<!{WORD}").otherwise(f"(?<={WORD}")
    return F.concat(literal, after, before, literal, F.lit(")"))


def exact_match(text: Column, title: Column) -> Column:
    """Whether the title occurs in the text as whole words, ignoring case."""
    return F.rlike(F.lower(text), whole_word_pattern(F.lower(title)))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def gaps_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(INNER_GAPS), F.lit(0))


def _single_keys(parts: Column, kind: str) -> Column:
    return F.array_distinct(F.transform(parts, lambda part: F.xxhash64(F.lit(kind), part)))


def _pairs(words: Column) -> Column:
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    neighbours = (F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs))
    return F.zip_with(*neighbours, lambda a, b: F.xxhash64(F.lit("pair"), a, b))


def _pair_keys(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def _triple_keys(words: Column) -> Column:
    triples = F.greatest(F.size(words) - 2, F.lit(0))
    neighbours = (F.slice(_pairs(words), F.lit(1), triples), F.slice(words, F.lit(3), triples))
    return F.array_distinct(F.zip_with(*neighbours, lambda pair, c: F.xxhash64(F.lit("triple"), pair, c)))


def title_keys(titles: DataFrame, title: str) -> DataFrame:
    """Add ``__kind`` and the hashed ``__keys`` of which every text that holds the title has all.

    A boundary at either end of a title means that its words are whole words of the text and follow
    each other there. So the keys are its triples of neighbouring words, or its only pair, or its only word. A title
    without a word is exactly what separates two words of the text.
    """
    words = F.col("__words")
    return (
        titles.withColumn("__words", words_of(F.col(title)))
        .withColumns(
            {
                "__kind": F.when(F.size(words) > 2, "triple").when(F.size(words) == 2, "pair").when(F.size(words) == 1, "word").otherwise("gap"),
                "__keys": F.when(F.size(words) > 2, _triple_keys(words))
                .when(F.size(words) == 2, _pair_keys(words))
                .when(F.size(words) == 1, _single_keys(words, "word"))
                .otherwise(_single_keys(F.array(F.lower(title)), "gap")),
            }
        )
        .drop("__words")
    )


def text_keys(texts: DataFrame, text: str, carried: list[str], kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """(carried columns, ``__key``): the words, neighbouring words and gaps between words of each text."""
    split = texts.select(*carried, words_of(F.col(text)).alias("__words"), gaps_of(F.col(text)).alias("__gaps"))
    keys = {
        "triple": _triple_keys(F.col("__words")),
        "pair": _pair_keys(F.col("__words")),
        "word": _single_keys(F.col("__words"), "word"),
        "gap": _single_keys(F.col("__gaps"), "gap"),
    }
    return split.select(*carried, F.explode(F.concat(*[keys[kind] for kind in kinds])).alias("__key"))


def match_titles(
    titles: DataFrame,
    texts: DataFrame,
    title: str,
    text: str,
    text_id: str,
    min_length: int = 6,
    inline_text: bool = False,
    salts: int = 8,
) -> DataFrame:
    """All (title row, text row) pairs in which the title occurs in the text as whole words.

    An equi-join on the rarest key of each title proposes pairs, and the regex decides. Text keys
    that no title has are dropped before any shuffle of them, by the keys of the titles while these can
    be broadcast, by their Bloom filter beyond that. What is left is made durable, because it is read twice: to count and to join. Each
    key is spread over ``salts`` tasks, so a key that many texts share is no bottleneck; the titles,
    the small side, are repeated for it. With ``inline_text`` the texts travel with their keys, which
    suits short ones; otherwise only their ids do, and the texts are joined back to the proposed pairs.
    ``text_id`` identifies a row of ``texts``.
    """
    clash = set(titles.columns) & set(texts.columns)
    if clash:
        raise ValueError(f"rename the columns both sides have: {sorted(clash)}")
    matched = matched_texts(titles, texts, title, text, text_id, min_length, inline_text, salts)
    return matched.join(titles, F.col("__title") == F.col(title)).select(*titles.columns, *texts.columns)


def matched_texts(
    titles: DataFrame,
    texts: DataFrame,
    title: str,
    text: str,
    text_id: str,
    min_length: int = 6,
    inline_text: bool = False,
    salts: int = 8,
) -> DataFrame:
    """:func:`match_titles` once for each different title, as ``__title``, however many rows have it, with the columns of ``texts``."""
    if min_length < 1:
        raise ValueError("an empty title would match every text")
    wanted = titles.where(F.length(title) >= min_length)
    # Written once: the titles are read for their keys, for the rarest of them and for the check.
    per_title = durable(title_keys(wanted.select(F.col(title).alias("__title")).distinct(), "__title"))
    keyed_titles = per_title.select("__title", "__kind", F.explode("__keys").alias("__key"))
    # At most one row per kind of key: how many keys there are to look for.
    counts = {r[0]: r[1] for r in keyed_titles.groupBy("__kind").agg(F.count_distinct("__key")).collect()}
    kinds = tuple(kind for kind in KINDS if kind in counts) or KINDS

    carried = texts.columns if inline_text else [text_id]
    title_side = keyed_titles.select("__key").distinct()
    all_keys = text_keys(texts.where(F.col(text).isNotNull()), text, carried, kinds)
    if sum(counts.values()) <= BROADCAST_ROWS:
        title_side = F.broadcast(title_side)
    else:
        # Too many to send: their Bloom filter goes instead, and only keys that pass it are shuffled.
        all_keys = BloomFilter(title_side, "__key", sum(counts.values())).may_hold(all_keys, "__key")
    keyed_texts = durable(all_keys.join(title_side, "__key", "left_semi"))

    frequency = keyed_texts.groupBy("__key").agg(F.count("*").alias("__texts"))
    rarest = (
        per_title.select("__title", F.size("__keys").alias("__wanted"), F.explode("__keys").alias("__key"))
        .join(frequency, "__key")
        .groupBy("__title", "__wanted")
        .agg(F.min_by("__key", F.struct("__texts", "__key")).alias("__key"), F.count("*").alias("__found"))
        # A title with a key that no text has cannot match.
        .where(F.col("__found") == F.col("__wanted"))
        .select("__title", "__key")
    )
    rarest = durable(rarest)
    # The other keys of the titles are no longer needed, and common ones are most of the rows.
    rare_keys = rarest.select("__key").distinct()
    if sum(counts.values()) <= BROADCAST_ROWS:  # one key per title, of all their keys
        rare_keys = F.broadcast(rare_keys)
    keyed_texts = keyed_texts.join(rare_keys, "__key", "left_semi")
    # Lowered once a title and once a text, not once for each pair proposed.
    rarest = rarest.withColumn("__lower_title", F.lower("__title")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_texts = keyed_texts.withColumn("__salt", F.pmod(F.xxhash64(text_id), F.lit(salts)).cast("int"))
    proposed = salted_texts.join(rarest, ["__key", "__salt"]).drop("__key", "__salt")
    lowered = F.lower(text).alias("__lower_text")
    proposed = proposed.select("*", lowered) if inline_text else proposed.join(texts.select("*", lowered), text_id)
    # Most pairs that are none fall out by plain search, without a regex.
    held = F.contains("__lower_text", "__lower_title") & F.rlike("__lower_text", whole_word_pattern(F.col("__lower_title")))
    return proposed.where(held).select("__title", *texts.columns)


def best_per_key(df: DataFrame, key: str, metric: str, ties: str = "all", tie_breakers: list | None = None) -> DataFrame:
    """Rows with the largest metric of their key; keys without any metric go.

    ``ties="all"`` keeps every row that shares the maximum. It joins with the maxima instead of
    ranking in a window, so that many ties do not have to fit into one task. ``ties="one"`` keeps one.
    """
    rated = df.where(F.col(metric).isNotNull())
    if ties == "one":
        return drop_duplicates_by_ordered_partition(rated, key, [F.col(metric).desc(), *(tie_breakers or [])])
    if ties != "all":
        raise ValueError("ties is 'all' or 'one'")
    best = rated.groupBy(key).agg(F.max(metric).alias("__best"))
    return rated.join(best, key).where(F.col(metric) == F.col("__best")).select(*df.columns)
