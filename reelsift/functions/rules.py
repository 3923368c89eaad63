"""Ordered regex rule ladders: first match wins, last match wins, or a cascade of rewrites."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.functions.text import as_column
from reelsift.lookups import MUSIC_GENRE_RULES, OTHER_GENRE, Rule
from reelsift.session import durable

# Alternatives that each span a whole line: ".*word.*|.*other.*".
WHOLE_LINE = re.compile(r"\.\*[^|()\\]*\.\*(\|\.\*[^|()\\]*\.\*)*")


def _searched(pattern: str) -> str:
    # Searching for ".*word.*" finds what searching for "word" finds, without the backtracking.
    if not WHOLE_LINE.fullmatch(pattern):
        return pattern
    return "|".join(alternative[2:-2] for alternative in pattern.split("|"))


def _ladder(value: Column, rules: list[Rule], default: Column, flags: str) -> Column:
    chain = F
    for pattern, label in rules:
        chain = chain.when(value.rlike(flags + _searched(pattern)), label)
    return chain.otherwise(default) if rules else default


def first_match(column: str | Column, rules: list[Rule], default: str | None, flags: str = "(?iu)") -> Column:
    """Label of the first rule found in the value, else ``default``; null stays null."""
    value = as_column(column)
    return F.when(value.isNotNull(), _ladder(value, rules, F.lit(default), flags))


def last_match(column: str | Column, rules: list[Rule], flags: str = "(?U)") -> Column:
    """Label of the last rule found in the value, else the value itself.

    Every rule looks at the original value, so the last match is the first one in reverse order.
    """
    value = as_column(column)
    return _ladder(value, rules[::-1], value, flags)


def _line_anchored(pattern: str) -> str:
    # ".*word.*" retries from every character of a line that lacks the word; anchored, it tries once.
    return f"(?m)^(?:{pattern})$" if WHOLE_LINE.fullmatch(pattern) else pattern


def cascade(column: str | Column, rules: list[Rule], flags: str = "(?i)") -> Column:
    """Replace what each rule matches by its label; later rules see the text left by earlier ones."""
    value = as_column(column)
    for pattern, label in rules:
        replacement = label.replace("\\", "\\\\").replace("$", "\\$")
        value = F.regexp_replace(value, flags + _line_anchored(pattern), replacement)
    return value


def map_genre(column: str | Column, rules: list[Rule] = MUSIC_GENRE_RULES, default: str = OTHER_GENRE) -> Column:
    """General genre of a music genre."""
    return first_match(column, rules, default)


def apply_per_distinct(df: DataFrame, column: str, new_column: str, rule) -> DataFrame:
    """Run ``rule`` once per distinct value of ``column`` and join the outcome back.

    For rules that cost more than a join, over values that repeat. The outcome is written first, so
    the planner knows its size: a small one is broadcast and the rows stay where they are; a large
    one is joined by shuffle, where a hot value is split.
    """
    mapped = durable(df.select(F.col(column).alias("__value")).distinct().withColumn("__label", rule("__value")))
    order = df.columns if new_column in df.columns else [*df.columns, new_column]
    joined = df.join(mapped, F.col(column).eqNullSafe(F.col("__value")), "left")
    return joined.withColumn(new_column, F.col("__label")).select(*order)
