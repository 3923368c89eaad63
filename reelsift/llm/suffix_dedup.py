"""Removal of byte strings that occur before, by a collection's Burrows-Wheeler transform built column by column.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier, in the input as it is.

1. Every place where such a string can start is keyed by the least hash among the ``ANCHOR``-byte strings in it. Equal
   strings have equal keys, and neighbouring places mostly the same one, so a run of places with one key is one
   *piece* of text, which begins at the run's first place and ends with the last place's string.
2. Pieces meet by key, as a few numbers each. Pieces that are equal throughout need no more: all but the earliest are
   removed. A key with several different pieces is contested, and the text of these goes to step 3.
3. Collections of contested pieces, whole keys and of bounded size each, are sorted by inserting one symbol of every
   piece per round, from the last column to the first. A round finds each new suffix's place by counting symbols in the
   transform so far, and rewrites the transform in one pass over it. From the round on in which suffixes have
   ``LENGTH`` symbols, the common prefixes with the neighbours are updated too. Runs of suffixes that share
   ``LENGTH`` symbols are equal strings, and all but the earliest are removed.
4. A key with more than ``CROWDED`` different pieces, as at the borders of a passage that very many documents share,
   would be one large task. Its strings are keyed by their own hash instead, and only minima are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.common import packed, prefix_hashes, ranges_for, slices, span_hashes, task_partitions, text_buffers
from reelsift.operators.ranking import global_row_number
from reelsift.session import durable

LENGTH = 100
ANCHOR = 24
#: Places in one piece at most; longer runs, as in repetitions, are several pieces of the same key.
PIECE_STARTS = 128
#: Bytes of contested pieces that are sorted at once; a key is never divided.
COLLECTION_BYTES = 96 << 10
CROWDED = 50_000
#: Pieces of one task among which equal ones are combined before the shuffle.
COMBINED = 500_000
#: Documents whose ids are sent to all tasks at most, to leave out other texts before a shuffle.
SENT_IDS = 500_000


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    if len(hashes) < width:
        return hashes[:0]
    out, span = hashes, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(hashes) - width + 1], out[width - span :])


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Row, first place in the row, places, key and hash of the text of every piece, and whether it may repeat itself."""
    n, width = len(data), length - ANCHOR + 1
    empty = np.zeros(0, np.int64)
    none = (empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty.astype(bool))
    if n < length:
        return none
    sums = prefix_hashes(data)
    at = np.arange(n - ANCHOR + 1)
    hashes = span_hashes(sums, at, at + ANCHOR)
    key = window_minima(hashes, width)
    size = np.diff(offsets)
    row = np.repeat(np.arange(len(size)), size)[: len(key)]
    inside = np.arange(len(key)) + length <= offsets[row + 1]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(begins)
    if not len(start):
        return none
    places = np.diff(np.append(np.searchsorted(np.flatnonzero(inside), start), int(inside.sum())))
    parts = -(-places // PIECE_STARTS)
    nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(start, parts) + nth * PIECE_STARTS
    places = np.minimum(np.repeat(places, parts) - nth * PIECE_STARTS, PIECE_STARTS)
    # A string can only stand twice in a piece if the least hash does, within the width of a window.
    edge = np.zeros(width - 1, np.uint64)
    anchors = np.flatnonzero(hashes == ~window_minima(~np.concatenate((edge, key, edge)), width))
    near = (hashes[anchors[1:]] == hashes[anchors[:-1]]) & (np.diff(anchors) <= width)
    twins = anchors[:-1][near]
    own = np.searchsorted(twins, first + places + width) > np.searchsorted(twins, first)
    return row[first], first - offsets[row[first]], places, key[first], span_hashes(sums, first, first + places + length - 1), own


def _combined(docs: DataFrame, repeated: bool) -> DataFrame:
    """``key, whole, doc, start, n`` of pieces: a task's first of each kind, or (``repeated``) all its others as ``doc, start, n``.

    With the others go the places of strings that a piece has twice itself.
    """

    def combine(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, start, n, key, whole = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((start, doc, whole, key))
        doc, start, n, key, whole = (c[order] for c in (doc, start, n, key, whole))
        again = np.zeros(len(doc), bool)
        again[1:] = (key[1:] == key[:-1]) & (whole[1:] == whole[:-1])
        if repeated:
            return pa.RecordBatch.from_arrays([pa.array(c[again]) for c in (doc, start, n)], ["doc", "start", "n"])
        return pa.RecordBatch.from_arrays([pa.array(c[~again]) for c in (key.view(np.int64), whole.view(np.int64), doc, start, n)], ["key", "whole", "doc", "start", "n"])

    def within(data: np.ndarray, at: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        """What pieces that repeat themselves have twice."""
        texts = [data[a : a + m + LENGTH - 1].tobytes() for a, m in zip(at.tolist(), n.tolist(), strict=True)]
        flags = repeated_places(texts, doc, start)
        rows = [(int(d), a, b - a - LENGTH + 1) for d, s, f in zip(doc, start, flags, strict=True) for a, b in _spans(f, int(s), LENGTH)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 3)], ["doc", "start", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for part in slices(batches, "text"):
            data, offsets = text_buffers(part.column("text"))
            row, *rest, own = pieces_of(data, offsets)
            doc = part.column("doc").to_numpy()
            held.append((doc[row], *rest))
            count += len(row)
            if repeated and own.any():
                # Of equal pieces the earliest is enough; the others are repetitions throughout.
                whole = np.lexsort((rest[0], doc[row], rest[3]))
                whole = whole[np.diff(rest[3][whole], prepend=rest[3][whole[:1]] ^ np.uint64(1)) != 0]
                own = whole[own[whole]]
                yield within(data, offsets[row[own]] + rest[0][own], doc[row[own]], rest[0][own], rest[1][own])
            if count >= COMBINED:
                yield combine(held)
                held, count = [], 0
        if held:
            yield combine(held)

    return docs.mapInArrow(read, "doc long, start long, n long" if repeated else "key long, whole long, doc long, start long, n long")


def _resolved(pieces: DataFrame) -> DataFrame:
    """Of rows sorted by key, text and place: those to remove, and the earliest of each text where a key has several.

    ``kind`` 0: removed, 1: contested. One row is carried from batch to batch.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "whole", "doc", "start", "n")
        held: tuple[np.ndarray, ...] | None = None  # the last first row, whose key may go on, and whether it was told

        def told(kind: int, rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(rows[0]), kind, np.int8)), *(pa.array(r) for r in (rows[0], *rows[2:]))], ["kind", "key", "doc", "start", "n"])

        for batch in batches:
            rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in names)
            if not len(rows[0]):
                continue
            contested_before = bool(held[5]) if held else False
            if held:
                rows = tuple(np.concatenate(([h], r)) for h, r in zip(held[:5], rows, strict=True))
            key, whole = rows[0], rows[1]
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
            yield told(0, tuple(r[~first] for r in rows))
            firsts = tuple(r[first] for r in rows)
            key = firsts[0]
            same = key[1:] == key[:-1]
            contested = np.zeros(len(key), bool)
            contested[1:] |= same
            contested[:-1] |= same
            tell = contested.copy()
            if held and contested_before:
                contested[0], tell[0] = True, False
            yield told(1, tuple(r[tell] for r in firsts))
            held = (*(r[-1] for r in firsts), contested[-1])

    return pieces.mapInArrow(read, "kind byte, key long, doc long, start long, n long")


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """How many bytes from ``a`` and from ``b`` on are the same, up to ``limit``; ``words`` has the 8 bytes from each place on."""
    out = np.zeros(len(a), np.int64)
    alive = np.arange(len(a))
    for done in range(0, limit, 8):
        differ = words[a[alive] + done] ^ words[b[alive] + done]
        lowest = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // 8)
        out[alive] = done + same
        alive = alive[differ == 0]
    return np.minimum(out, limit)


def column_symbols(data: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, int]:
    """A number for the column that begins at each place, in the order of the columns' bytes, and how many bytes a column has.

    Columns are as wide, up to 8 bytes, as 16 bits can tell the different ones apart; past a piece's end (``left`` bytes
    on) they are filled with zeros.
    """
    widest = np.zeros(len(data), np.uint64)
    for k in range(8):
        value = np.zeros(len(data), np.uint64)
        value[: max(len(data) - k, 0)] = data[k:]
        value[left <= k] = 0
        widest |= value << np.uint64(8 * (7 - k))
    ordered = np.sort(widest)
    for width in (8, 6, 4, 3, 2):
        shift = np.uint64(8 * (8 - width))
        whole, there = widest >> shift, ordered >> shift
        there = there[np.diff(there, prepend=there[:1] ^ np.uint64(1)) != 0]
        if len(there) < 65_000:
            return (np.searchsorted(there, whole) + 1).astype(np.uint16), width
    return data.astype(np.uint16) + 1, 1


def sorted_collection(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes of ``length`` bytes and more, in sorted order, and each one's common prefix with the one before.

    ``data`` holds the pieces one after another. Column by column from the pieces' ends, one symbol per piece and round: a symbol is a
    column of ``width`` bytes, and a piece is inserted ``width`` times, once from each of its first places, so that every place begins a suffix.
    ``bwt`` is the symbol before each suffix so far (0: none), in the order of the suffixes; ``at`` is where each piece's
    last suffix stands in it. The suffix with one more symbol stands behind all that begin with smaller symbols, and
    behind as many with its own as there are of it in ``bwt`` before ``at``.
    """
    size = np.diff(offsets)
    symbols, width = column_symbols(data, np.repeat(offsets[1:], size) - np.arange(len(data)))
    words = packed(np.append(data, np.zeros(length + 16, np.uint8)), 8)
    # A piece from each of its first places on: where that is, how many columns it has, and where its text ends.
    begin = np.repeat(offsets[:-1], width) + np.tile(np.arange(width), len(size))
    end = np.repeat(offsets[1:], width)
    columns = np.maximum(-(-(end - begin) // width), 0)
    pieces = len(begin)
    # Round 0: the empty suffixes, in the order of the pieces.
    piece = np.flatnonzero(columns)
    at = piece
    bwt = np.zeros(pieces, np.uint16)
    bwt[piece] = symbols[begin[piece] + (columns[piece] - 1) * width]
    suffix = common = None
    done = 0
    while len(piece):
        done += 1
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(len(bwt), np.int32)
        rank[order] = np.arange(len(bwt), dtype=np.int32)
        at = rank[at] - int(np.count_nonzero(bwt == 0)) + pieces
        place = begin[piece] + (columns[piece] - done) * width
        going = columns[piece] > done
        symbol = np.zeros(len(piece), np.uint16)
        symbol[going] = symbols[place[going] - width]
        grown = np.empty(len(bwt) + len(piece), np.uint16)
        old = np.ones(len(grown), bool)
        old[at] = False
        grown[old], grown[at] = bwt, symbol
        if done * width >= length:
            if suffix is None:
                suffix, common = np.full(len(bwt), -1, np.int32), np.zeros(len(bwt), np.uint8)
            places, lcp = np.empty(len(grown), np.int32), np.zeros(len(grown), np.uint8)
            places[old], places[at] = suffix, np.where(end[piece] - place >= length, place, -1)
            lcp[old] = common
            for here in (at, np.minimum(at + 1, len(grown) - 1)):  # the new ones, and those that now stand behind them
                lcp[here] = 0
                pair = here[here > 0]
                pair = pair[(places[pair] >= 0) & (places[pair - 1] >= 0)]
                lcp[pair] = common_prefixes(words, places[pair - 1], places[pair], length)
            suffix, common = places, lcp
        bwt = grown
        piece, at = piece[going], at[going]
    if suffix is None:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    long = suffix >= 0
    return suffix[long].astype(np.int64), common[long]


def repeated_places(texts: list[bytes], docs: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece, which of its places begin a string that also starts earlier in one of the pieces."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    data = np.frombuffer(b"".join(texts), np.uint8)
    suffix, common = sorted_collection(data, offsets, length)
    if not len(suffix):
        return [np.zeros(0, bool) for _ in texts]
    piece = np.searchsorted(offsets, suffix, side="right") - 1
    group = np.cumsum(common < length)
    start = starts[piece] + suffix - offsets[piece]
    order = np.lexsort((start, docs[piece], group))
    again = np.zeros(len(suffix), bool)
    g, d, s = group[order], docs[piece][order], start[order]
    again[1:] = (g[1:] == g[:-1]) & ((d[1:] != d[:-1]) | (s[1:] != s[:-1]))
    flags = np.zeros(len(data) + 1, bool)
    flags[suffix[order]] = again
    return [flags[a : b - length + 1] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _spans(flags: np.ndarray, start: int, length: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [(start + int(a), start + int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _sorted_spans(pieces: DataFrame) -> DataFrame:
    """``doc, a, b`` of what is repeated among pieces (``key, doc, start, bytes``) sorted by key."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def told() -> pa.RecordBatch:
            doc, start = (np.array([h[k] for h in held], np.int64) for k in (1, 2))
            flags = repeated_places([h[3] for h in held], doc, start)
            rows = [(int(d), *span) for d, s, f in zip(doc, start, flags, strict=True) for span in _spans(f, int(s), LENGTH)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [()] * 3)], ["doc", "a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "start", "bytes")), strict=True):
                if size > COLLECTION_BYTES and row[0] != held[-1][0]:
                    yield told()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield told()

    return pieces.mapInArrow(read, "doc long, a long, b long")


def _with_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``key, doc, start, n``) with ``bytes``, the text of each piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = []
            for doc, text, list_ in zip(part.column("doc").to_pylist(), part.column("text").to_pylist(), part.column("wanted").to_pylist(), strict=True):
                raw = text.encode()
                rows += [(w["key"], doc, w["start"], raw[w["start"] : w["start"] + w["n"] + LENGTH - 1]) for w in list_]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["key", "doc", "start", "bytes"])

    # What a document is asked for is at most as much as it has.
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "n")).alias("wanted"))
    return docs.join(lists, "doc").select("doc", "text", "wanted").mapInArrow(cut, "key long, doc long, start long, bytes binary")


def _crowded_spans(pieces: DataFrame) -> DataFrame:
    """``doc, a, b`` of what is repeated among pieces, string by string: for keys with too many pieces for one task."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            raw = part.column("bytes").to_pylist()
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in raw])))
            data = np.frombuffer(b"".join(raw), np.uint8)
            n = np.diff(offsets) - LENGTH + 1
            row = np.repeat(np.arange(len(n)), n)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = offsets[row] + nth
            one = span_hashes(prefix_hashes(data), at, at + LENGTH)
            two = span_hashes(prefix_hashes(data[::-1]), len(data) - at - LENGTH, len(data) - at)
            doc, start = (part.column(c).to_numpy() for c in ("doc", "start"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (one.view(np.int64), two.view(np.int64), doc[row], start[row] + nth)], ["one", "two", "doc", "start"])

    strings = durable(pieces.mapInArrow(hashed, "one long, two long, doc long, start long"))
    first = strings.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("first"))
    again = strings.join(first, ["one", "two"]).where(F.struct("doc", "start") != F.col("first"))
    return again.select("doc", F.col("start").alias("a"), (F.col("start") + LENGTH).alias("b"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc, a, b``: byte spans of ``docs`` (``doc`` unique and not null, ``text``) to remove; spans may overlap."""
    spark = docs.sparkSession
    keyed = _combined(docs, repeated=False)
    parts = max(task_partitions(spark), ranges_for(docs, "text"))
    resolved = durable(_resolved(keyed.repartition(parts, "key").sortWithinPartitions("key", "whole", "doc", "start")))
    removed = resolved.where("kind = 0").select("doc", "start", "n").unionByName(_combined(docs, repeated=True))
    spans = removed.select("doc", F.col("start").alias("a"), (F.col("start") + F.col("n") + LENGTH - 1).alias("b"))
    contested = resolved.where("kind = 1").drop("kind")
    ids = durable(contested.select("doc").distinct())
    texts = docs
    if ids.count() <= SENT_IDS:
        texts = docs.join(F.broadcast(ids), "doc", "left_semi")
    crowded = contested.groupBy("key").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWDED).select("key")
    crowded = durable(crowded)
    pieces = _with_bytes(texts, contested)
    if crowded.isEmpty():
        calm = pieces
    else:
        pieces = durable(pieces)
        calm = pieces.join(crowded, "key", "left_anti")
        spans = spans.unionByName(_crowded_spans(pieces.join(crowded, "key", "left_semi")))
    found = _sorted_spans(calm.repartition(parts, "key").sortWithinPartitions("key", "doc", "start"))
    return spans.unionByName(found)


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with ``doc``, a number for each document in their order, and whether it differs from ``doc_id``.

    Without nulls and repetitions ``doc_id`` is that number. Otherwise null ids come first, and rows with the same id by a hash
    of the text; rows that agree in both are one document, not repetitions of each other.
    """
    n, distinct = docs.agg(F.count("*"), F.countDistinct("doc_id")).first()
    if n == distinct:
        return docs.withColumn("doc", F.col("doc_id")), False
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    order = global_row_number(hashed.select("doc_id", "_hash").distinct(), ["doc_id", "_hash"], "doc")
    left, right = hashed.alias("l"), order.alias("r")
    joined = left.join(right, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("doc_id", "_hash")])
    return durable(joined.select("l.doc_id", "l.text", "r.doc")), True


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, kept`` (binary, what remains of its UTF-8), ``spans`` (removed, as ``[a, b)`` pairs, maximal), ``n_bytes``.

    Null texts are empty. Other columns are ignored. Strings are judged on the input, within documents too.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            kept, spans, sizes = [], [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("found").to_pylist(), strict=True):
                raw = text.encode()
                merged: list[list[int]] = []
                for s in sorted((s["a"], s["b"]) for s in found or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                at, rest = 0, []
                for a, b in merged:
                    rest.append(raw[at:a])
                    at = b
                kept.append(b"".join([*rest, raw[at:]]))
                spans.append([x for s in merged for x in s])
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["doc_id", "kept", "spans", "n_bytes"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows, renumbered = numbered(rows)
    texts = rows.select("doc", "text")
    texts = texts.dropDuplicates(["doc"]) if renumbered else texts
    # A document has no more spans than one for every few bytes of it.
    found = repeated_spans(texts).groupBy("doc").agg(F.collect_set(F.struct("a", "b")).alias("found"))
    return rows.join(found, "doc", "left").select("doc_id", "text", "found").mapInArrow(cut, "doc_id long, kept binary, spans array<long>, n_bytes long")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            kept, spans = part.column("kept").to_pylist(), part.column("spans").to_pylist()
            removed = [sum(s[1::2]) - sum(s[::2]) for s in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(removed, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return without_repeats(docs).mapInArrow(told, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
