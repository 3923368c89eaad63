"""Compression of vectors to one code per part: product codebooks by Lloyd's rounds whose members stay where they are.

1. A vector's components become integers, and the vector is cut into consecutive parts. Parts that are equal at one
   position are one row with their number, so a vector that a third of all rows hold is one row per position.
2. Rows are placed once by (position, entry, salt), the salt a hash of the part, so an entry with any share of the rows is
   spread over as many owners as it needs. A round's owners add up their resident members; only the sums, one row per
   entry and component, leave them.
3. Under the new codebook every owner assigns its residents again. Members that keep their entry stay in the file that
   they are in; only those that change it go through the next shuffle to their new owners.
4. The last assignment reads the vectors once more, with the final codebook, so codes need no gathering of parts.

A codebook is ``parts x entries`` rows however many vectors there are; it is the only thing that all tasks get.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from reelsift.llm.common import task_partitions
from reelsift.session import durable

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Members of an owner, about.
OWNED = 2048
#: Components beyond this (after scaling) are refused: their squared distances need not fit a long.
LARGEST = 1 << 27
#: Up to this size the products and sums of a distance are exact in double precision.
_EXACT = 1 << 20
_ROWS = 2048


def whole_vectors(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vector is there and finite, and their components as integers, one row each."""
    column = batch.column("vector")
    lengths = np.asarray(column.value_lengths().fill_null(-1))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes NaN
    ends = np.cumsum(np.maximum(lengths, 0))
    finite = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    kept = np.flatnonzero((lengths >= 0) & (finite[ends] == finite[ends - np.maximum(lengths, 0)]))
    if not len(kept):
        return kept, np.zeros((0, 0), np.int64)
    if len(set(lengths[kept].tolist())) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(set(lengths[kept].tolist()))[:5]}")
    width = int(lengths[kept[0]])
    rows = values[(ends - lengths)[kept][:, None] + np.arange(width)]
    scaled = np.floor(rows * scale)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // scale}")
    return kept, scaled.astype(np.int64)


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the first of several, and the squared distance to it."""
    chosen, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    exact = max(np.abs(parts).max(initial=0), np.abs(entries).max(initial=0)) <= _EXACT and parts.shape[1] <= 1024
    for first in range(0, len(parts), _ROWS):
        some = parts[first : first + _ROWS]
        if exact:
            a, b = some.astype(np.float64), entries.astype(np.float64)
            squares = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
        else:
            squares = np.zeros((len(some), len(entries)), np.int64)
            for k in range(parts.shape[1]):
                squares += (some[:, k, None] - entries[None, :, k]) ** 2
        at = squares.argmin(1)
        chosen[first : first + _ROWS], distance[first : first + _ROWS] = at, squares[np.arange(len(some)), at]
    return chosen, distance


def _lists(rows: np.ndarray) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(rows).ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _split(rows: np.ndarray, parts: int) -> np.ndarray:
    """Parts by position: ``parts x rows x width``."""
    if rows.shape[1] % parts:
        raise ValueError(f"vectors of {rows.shape[1]} components have no {parts} equal parts")
    return rows.reshape(len(rows), parts, rows.shape[1] // parts).transpose(1, 0, 2)


def _first_codebook(vectors: DataFrame, key: str, entries: int, parts: int, scale: int) -> np.ndarray | None:
    """The parts of the ``entries`` vectors with the least keys: the driver holds so many rows and no more."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = whole_vectors(batch, scale)
            if len(kept):
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(kept)), _lists(rows)], [key, "v"])

    kind = vectors.schema[key].dataType.simpleString()
    first = vectors.mapInArrow(read, f"`{key}` {kind}, v array<long>").orderBy(F.col(key).asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    if len({len(r.v) for r in first}) > 1:
        raise ValueError("vectors of different lengths")
    return np.ascontiguousarray(_split(np.array([r.v for r in first], np.int64).reshape(len(first), -1), parts))


def _placed(vectors: DataFrame, book: np.ndarray, parts: int, scale: int, salts: int, partitions: int) -> DataFrame:
    """``position, entry, salt, part, n``: each different part of a position with its first entry, at its owner."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = whole_vectors(batch, scale)
            if not len(kept):
                continue
            for position, some in enumerate(_split(rows, parts)):
                different, count = np.unique(some, axis=0, return_counts=True) if some.shape[1] else (some[:1], np.array([len(some)]))
                entry, _ = nearest_entries(different, book[position])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(count), position, np.int32)), pa.array(entry.astype(np.int32)), _lists(different), pa.array(count)],
                    ["position", "entry", "part", "n"],
                )

    rows = vectors.mapInArrow(read, "position int, entry int, part array<long>, n long")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("part"), F.lit(salts)).cast("int"))
    owned = salted.repartition(partitions, "position", "entry", "salt")
    return owned.groupBy("position", "entry", "salt", "part").agg(F.sum("n").alias("n"))


def _updated(state: DataFrame, book: np.ndarray) -> np.ndarray:
    """The codebook after the owners' sums: ``floor(sum / count)`` in every component, entries without members as before."""
    parts, entries, width = book.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            at = batch.column("position").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
            n = batch.column("n").to_numpy()
            np.add.at(counts, at, n)
            np.add.at(sums, at, _matrix(batch.column("part"), width) * n[:, None])
        there = np.flatnonzero(counts)
        # The component numbered `width` is the count.
        wide = np.column_stack((sums[there], counts[there]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(there, width + 1)), pa.array(np.tile(np.arange(width + 1), len(there))), pa.array(wide.ravel())], ["at", "component", "total"]
        )

    # One number per entry and component, however many members there are.
    totals = state.mapInArrow(add, "at long, component long, total long").groupBy("at", "component").agg(F.sum("total").alias("total")).collect()
    sums = np.zeros((parts * entries, width + 1), np.int64)
    for r in totals:
        sums[r.at, r.component] = r.total
    count = sums[:, width:]
    new = np.where(count > 0, sums[:, :width] // np.maximum(count, 1), book.reshape(parts * entries, width))
    return new.reshape(book.shape)


def _assigned(state: DataFrame, book: np.ndarray) -> DataFrame:
    """The residents with the entry they have (``home``) and the one they are nearest to now (``entry``)."""
    width = book.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, rows = batch.column("position").to_numpy(), _matrix(batch.column("part"), width)
            entry = np.zeros(len(rows), np.int32)
            for p in np.unique(position):
                here = position == p
                entry[here] = nearest_entries(rows[here], book[p])[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("position", "salt", "part", "n")] + [batch.column("entry"), pa.array(entry)], ["position", "salt", "part", "n", "home", "entry"]
            )

    return state.mapInArrow(assign, "position int, salt int, part array<long>, n long, home int, entry int")


def fit_codebooks(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> np.ndarray | None:
    """``parts x entries x width`` integers, or None where no vector is kept; see :func:`encode_vectors` for which are."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key), F.col(column).alias("vector"))
    book = _first_codebook(rows, key, entries, parts, scale)
    if book is None:
        return None
    n = rows.count()
    partitions = max(task_partitions(spark), n * parts // 1_000_000 + 1)
    salts = max(1, -(-n // OWNED))
    names = ["position", "entry", "salt", "part", "n"]
    state = durable(_placed(rows.select("vector"), book, parts, scale, salts, partitions).select(*names))
    for done in range(rounds):
        book = _updated(state, book)
        if done + 1 < rounds:
            assigned = durable(_assigned(state, book))
            stay = assigned.where("home = entry").select(*names)
            moved = assigned.where("home != entry").select(*names).repartition(partitions, "position", "entry", "salt")
            state = stay.unionByName(durable(moved))
    return book


def encode_vectors(vectors: DataFrame, book: np.ndarray | None, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows of ``vectors`` that are kept, all columns but the vector, with ``code`` and ``error``.

    Rows whose vector is null or holds a null or non-finite component are left out; all others need one length that the
    codebook's parts divide, and components whose scaled value is at most ``LARGEST``; anything else is an error. ``code``
    has two hex digits per part (entry numbers from 0), ``error`` is the sum of the squared distances to the entries. Empty vectors have
    entry 0 throughout. Repeated rows and repeated ids are rows like any other. A column that is called ``code`` or
    ``error`` already is replaced.
    """
    others = [f for f in vectors.schema.fields if f.name not in (column, "code", "error")]
    names = [f"_{k}" for k in range(len(others))]  # whatever the columns are called, the vector's name is its own
    out = StructType([*others, StructField("code", StringType()), StructField("error", LongType())])
    if book is None:
        return vectors.sparkSession.createDataFrame([], out)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, rows = whole_vectors(batch, scale)
            if not len(kept):
                continue
            codes, errors = np.zeros((len(kept), len(book)), np.uint8), np.zeros(len(kept), np.int64)
            for position, some in enumerate(_split(rows, len(book))):
                entry, distance = nearest_entries(some, book[position])
                codes[:, position] = entry
                errors += distance
            told, at = [c.tobytes().hex() for c in codes], pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in names] + [pa.array(told), pa.array(errors)], out.names)

    renamed = [F.col(f"`{f.name}`").alias(c) for f, c in zip(others, names, strict=True)]
    return vectors.select(*renamed, F.col(f"`{column}`").alias("vector")).mapInArrow(encode, out)


def codes_with_label_errors(
    vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256``: :func:`encode_vectors` with the errors summed over equal labels, nulls together."""
    book = fit_codebooks(vectors, key, column, parts, entries, rounds, scale)
    picked = vectors.select(F.col(key), F.col(label).alias("_label"), F.col(column).alias("_vector"))
    codes = durable(encode_vectors(picked, book, "_vector", scale))
    # One row per label; written, so that the planner sends it to all tasks only if it is small.
    totals = durable(codes.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error")))
    joined = codes.join(totals, F.col("_label").eqNullSafe(F.col("_of")))
    return joined.select(key, "code", "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256"))


def codebooks_digest(book: np.ndarray | None) -> str:
    """SHA-256 of all entries' components by part, entry and position within the part, as decimals joined by commas."""
    told = "" if book is None else ",".join(map(str, book.ravel().tolist()))
    return hashlib.sha256(told.encode()).hexdigest()
