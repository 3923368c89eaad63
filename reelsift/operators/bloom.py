"""Bloom filters of key columns, sent instead of the keys, so that rows whose key is nowhere are not shuffled.

A filter is a table of 64-bit words. A key's hash chooses one word and ``BITS`` bits in it, so a lookup is one equi-join with a
table of numbers, whatever type and length the keys have. No key of the filter is ever missed; other keys pass at about
the rate that :func:`error_rate` tells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsift.session import durable

BITS = 5
BITS_PER_KEY = 16
#: Words of a filter at most, which bounds what is sent (16 bytes a word); with more keys the rate of errors rises.
MOST_WORDS = 4_000_000


def _hash(key: Column) -> Column:
    return F.xxhash64(F.lit(29), key)


def _word(key: Column, words: int) -> Column:
    return F.pmod(_hash(key), F.lit(words))


def _mask(key: Column) -> Column:
    """The key's bits: five groups of six bits of a second hash."""
    second = F.xxhash64(F.lit(31), key)
    out = F.lit(0).cast("bigint")
    for k in range(BITS):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return out


def error_rate(keys: int, words: int) -> float:
    """The share of other keys that pass, about: that ``BITS`` bits of a word are set by its keys, whose number is a Poisson one."""
    load = keys / words
    rate, chance, n = 0.0, math.exp(-load), 0
    while n < 10 * load + 50:
        rate += chance * (1 - (1 - 1 / 64) ** (BITS * n)) ** BITS
        n += 1
        chance *= load / n
    return rate


class BloomFilter:
    """The filter of the non-null values of a column."""

    def __init__(self, keys: DataFrame, column: str, n_keys: int | None = None):
        """``n_keys`` is the number of distinct keys, if it is known; it sizes the filter and is counted otherwise."""
        listed = keys.select(F.col(column).alias("key")).where("key IS NOT NULL")
        self.n_keys = listed.distinct().count() if n_keys is None else n_keys
        self.words = max(1, min(-(-self.n_keys * BITS_PER_KEY // 64), MOST_WORDS))
        bits = listed.select(_word(F.col("key"), self.words).alias("__word"), _mask(F.col("key")).alias("__mask"))
        # Written: MOST_WORDS rows at most, which is what makes sending them safe.
        self.table = durable(bits.groupBy("__word").agg(F.bit_or("__mask").alias("__bits")))

    @property
    def error_rate(self) -> float:
        return error_rate(self.n_keys, self.words)

    def may_hold(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of ``df`` whose value may be among the keys: all that are, and a few that are not. Null values go."""
        key = F.col(column)
        marked = df.withColumns({"__word": _word(key, self.words), "__mask": _mask(key)}).where(key.isNotNull())
        joined = marked.join(F.broadcast(self.table), "__word")
        return joined.where(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask")).select(*[F.col(f"`{c}`") for c in df.columns])
