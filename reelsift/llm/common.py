"""What the operators share: bounded slices of Arrow batches, byte arithmetic on whole batches, ordered sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def splitting_pattern() -> str:
    """The pattern that splits text before the merges of the rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def task_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranges_for(df: DataFrame, column: str, target_bytes: int = 64 << 20) -> int:
    """Partitions for a shuffle of ``column``: as many as the session says, more where they would exceed ``target_bytes``."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(task_partitions(df.sparkSession), -(-total // target_bytes))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_buffers(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the offsets of its rows in them (a null is empty), without copying."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = offsets[0] if len(offsets) else 0
    return whole[start : offsets[-1]] if len(offsets) else whole[:0], offsets - start


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers under which equal-looking ones end far apart."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * _MULTIPLIER
    return x ^ (x >> np.uint64(32))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


_CACHE: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE["up"]) < n:
        size = 1 << (n - 1).bit_length()
        up, down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        if size > 8 * SLICE_BYTES:  # a very long text: not kept
            return up[:n], down[:n]
        _CACHE["up"], _CACHE["down"] = up, down
    return _CACHE["up"][:n], _CACHE["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums to which :func:`span_hashes` takes differences; one more than there are bytes."""
    up, _ = _tables(len(data))
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte strings ``[start, end)``; equal strings have equal ones wherever they stand."""
    _, down = _tables(len(sums))
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _MULTIPLIER)


def packed(data: np.ndarray, q: int) -> np.ndarray:
    """The ``q`` (at most 8) bytes from each place on as one integer."""
    out = np.zeros(max(len(data) - q + 1, 0), np.uint64)
    for k in range(q):
        out |= data[k : k + len(out)].astype(np.uint64) << np.uint64(8 * k)
    return out


#: Words up to so many bytes are hashed for a whole batch at once, longer ones one by one.
_LONG = 96


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, with zeros after the end."""
    out = np.zeros(len(data) + 8, np.uint64)
    out[: len(data)] = data
    for k in (1, 2, 4):
        out[:-k] |= out[k:] << np.uint64(8 * k)
    return out


def _upto(length: np.ndarray, k: int) -> np.ndarray:
    """Masks for the bytes ``k`` to ``k + 8`` of strings longer than ``k``."""
    return np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.minimum(length - k, 8).astype(np.uint64) * np.uint64(8))


def same_strings(a: tuple[np.ndarray, np.ndarray], at_a: np.ndarray, b: tuple[np.ndarray, np.ndarray], at_b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the strings of ``length`` bytes at ``at_a`` and ``at_b`` are equal, byte for byte; ``a`` and ``b`` are bytes with their :func:`eights`."""
    out = np.ones(len(length), bool)
    some = np.flatnonzero(length <= _LONG)
    for k in range(0, _LONG, 8):
        some = some[length[some] > k]
        if not len(some):
            break
        out[some] &= ((a[1][at_a[some] + k] ^ b[1][at_b[some] + k]) & _upto(length[some], k)) == 0
    for k in np.flatnonzero(length > _LONG):
        out[k] = np.array_equal(a[0][at_a[k] : at_a[k] + length[k]], b[0][at_b[k] : at_b[k] + length[k]])
    return out


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, eight: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte strings ``[start, end)``, eight bytes after eight, each step mixed before the next.

    Unlike :func:`span_hashes`, which is a polynomial modulo 2**64, no pattern of bytes makes different strings meet: with the
    same beginning, strings that differ in one step differ after it. ``eight`` is :func:`eights` of ``data``, if it is there already.
    """
    length = end - start
    out = mixed(length.astype(np.uint64) + _MULTIPLIER)
    if not len(out):
        return out
    eight = eights(data) if eight is None else eight
    some = np.flatnonzero(length <= _LONG)
    for k in range(0, _LONG, 8):
        some = some[length[some] > k]
        if not len(some):
            break
        chunk = eight[start[some] + k] & _upto(length[some], k)
        out[some] = mixed((out[some] ^ chunk) * _MULTIPLIER)
    for k in np.flatnonzero(length > _LONG):
        out[k] = xxhash.xxh3_64_intdigest(data[start[k] : end[k]])
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (bytes other than ASCII white space), and the first word of each row with one more at the end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    # A word that reaches a row's end does not go on into the next row.
    borders = offsets[1:-1]
    borders = np.unique(borders[(borders > 0) & (borders < len(data))])
    borders = borders[inside[borders] & inside[borders + 1]]
    begins[borders] = True
    ends[borders] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return start, end, np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """For each row the sorted distinct hashes of its word ``size``-grams, concatenated, and the rows' offsets in them.

    A row of fewer words has one shingle of all its words, a row without words none.
    """
    start, end, first = words(data, offsets)
    each = word_hashes(data, start, end)
    n_words = np.diff(first)
    n = np.where(n_words == 0, 0, np.maximum(n_words - size + 1, 1))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[:-1], n)
    last = first[1:][row]
    out = np.full(len(row), 7, np.uint64)
    for k in range(size):
        there = at + k < last
        value = np.where(there, each[np.minimum(at + k, max(len(each) - 1, 0))] if len(each) else np.uint64(0), np.uint64(k + 1))
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + value)
    order = np.lexsort((out, row))
    out = out[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[keep], np.concatenate(([0], np.cumsum(np.bincount(row[keep], minlength=len(n)))))


def ordered_sums(df: DataFrame, keys: list[str], block: str, order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of the same ``keys`` before it, by ``block`` and then ``order``.

    A key's rows may be any share of all: only the rows of one block meet in a task. The blocks' own sums, one row
    per key and block, are what the second window runs over.
    """
    within = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*keys, block).agg(F.sum(value).alias("_block_sum"))
    sums = sums.withColumn("_blocks_before", F.coalesce(F.sum("_block_sum").over(across), F.lit(0))).drop("_block_sum")
    left, right = df.alias("_l"), sums.alias("_r")
    on = [F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")) for c in (*keys, block)]
    joined = left.join(right, on).select("_l.*", "_r._blocks_before")
    return joined.withColumn(out, F.col("_blocks_before") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_blocks_before")
