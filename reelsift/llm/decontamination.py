"""Benchmark decontamination: benchmark items that stand in documents, up to a number of edits.

An item of ``m`` bytes with at most ``e`` edits keeps ``m - q + 1 - q * e`` of its q-grams, and they lie on at most
``e + 1`` neighbouring diagonals (place in the document minus place in the item). Shared q-grams are counted in bands of
``2 * (e + 1)`` diagonals that overlap by half, so those of a match always fall into one band. Regions whose count
meets the bound are verified by an alignment within the band.

Items and texts are compared as UTF-8 with white space as one blank and ASCII and Latin-1 letters in lower case.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.common import packed, slices, text_buffers
from reelsift.session import durable

Q = 8
EDIT_RATE = 0.1
#: Bytes of items that are looked for in one pass over the documents; a larger benchmark takes several passes.
PASS_BYTES = 8 << 20
#: Places of q-grams in items that are counted at a time; more are counted in runs of texts, or of overlapping parts of a text.
HITS = 1_500_000
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[65:91] += 32
_FOLDED[9:14] = 32
_BITS = 22
#: Row, item, band and place are packed into one integer where they need less than this.
_PACKED = 1 << 63


def normalized(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, offsets of the rows in them, and where each byte was before."""
    out = _FOLDED[data]
    if len(out) > 1:
        second = out[1:]
        latin = (data[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[latin] += 32
    blank = out == 32
    keep = np.ones(len(out), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    begins = offsets[:-1][np.diff(offsets) > 0]
    keep[begins] = ~blank[begins]  # none at the beginning
    place = np.flatnonzero(keep)
    return out[place], np.searchsorted(place, offsets), place


def budget(length: int, q: int = Q, rate: float = EDIT_RATE) -> int:
    """Edits allowed in an item: the rate's share of its bytes, but no more than leave it one q-gram."""
    return min(int(length * rate), (length - q) // q)


@dataclass(frozen=True)
class ItemIndex:
    """The q-grams of some items, sorted, with their places."""

    ids: list[int]
    items: list[bytes]
    edits: np.ndarray
    needed: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    present: np.ndarray
    #: By length, the items of fewer than ``q`` bytes: their bytes as integers, sorted, and their numbers in ``ids``.
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[int, str]], q: int, rate: float) -> ItemIndex:
        kept, below = [], []
        for i, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            folded = normalized(data, np.array([0, len(data)]))[0].tobytes().strip()
            if len(folded) >= q:
                kept.append((i, folded))
            elif folded:
                below.append((i, folded))
        edits = np.array([budget(len(t), q, rate) for _, t in kept], np.int64)
        lengths = np.array([len(t) for _, t in kept], np.int64)
        grams = [packed(np.frombuffer(t, np.uint8), q) for _, t in kept]
        item = np.repeat(np.arange(len(kept)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        whole = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(whole, kind="stable")
        unique, first = np.unique(whole[order], return_index=True)
        present = np.zeros(1 << _BITS, bool)
        present[_slot(unique)] = True
        short = {}
        for size in {len(t) for _, t in below}:
            those = sorted((int.from_bytes(t, "little"), len(kept) + n) for n, (_, t) in enumerate(below) if len(t) == size)
            short[size] = (np.array([t for t, _ in those], np.uint64), np.array([n for _, n in those], np.int64))
        return ItemIndex([i for i, _ in kept + below], [t for _, t in kept], edits, lengths - q + 1 - q * edits, unique, np.append(first, len(whole)), item[order], place[order], present, short)


def _slot(grams: np.ndarray) -> np.ndarray:
    return ((grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BITS)).astype(np.int64)


def aligned(item: bytes, region: bytes, low: int, width: int) -> tuple[int, int]:
    """Least edits that turn ``item`` into a part of ``region``, and that part's end.

    Only diagonals from ``low`` on, ``width`` of them, are visited; diagonal ``k`` begins at ``region[k]``.
    """
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(region, np.uint8)
    far = 1 << 20
    shift = np.arange(width)
    text = np.full(len(a) + width, -1, np.int16)  # text[t] stands for region[low + t]
    begin, end = max(0, -low), min(len(text), len(b) - low)
    if end > begin:
        text[begin:end] = b[low + begin : low + end]
    cost = np.where((low + shift >= 0) & (low + shift <= len(b)), 0, far)
    for i in range(len(a)):
        inside = low + i + 1 + shift <= len(b)
        step = cost + (text[i : i + width] != a[i])
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        cost = np.minimum.accumulate(np.where(inside & (low + i + 1 + shift >= 0), step, far) - shift) + shift
    best = int(cost.argmin())
    return int(cost[best]), low + len(a) + best


def _short_matches(text: np.ndarray, at: np.ndarray, index: ItemIndex) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, start, end) of the first place of each item of fewer than ``q`` bytes in each row, in ``text``."""
    for size, (wanted, item) in index.short.items():
        grams = packed(text, size)
        first = np.searchsorted(wanted, grams)
        hit = np.flatnonzero(wanted[np.minimum(first, len(wanted) - 1)] == grams)
        row = np.searchsorted(at, hit, side="right") - 1
        within = hit + size <= at[row + 1]
        hit, row = hit[within], row[within]
        _, begins = np.unique(row * len(wanted) + first[hit], return_index=True)
        for h, r in zip(hit[begins].tolist(), row[begins].tolist(), strict=True):
            for n in range(int(first[h]), int(np.searchsorted(wanted, grams[h], side="right"))):
                yield r, int(item[n]), h, h + size


def _counted(pair: np.ndarray, band: np.ndarray, place: np.ndarray, pairs: int, bands: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair and band of row and item that share q-grams, and how many of the item's places: each counts in its band and the one before."""
    numbers = None
    if pairs * bands * longest >= _PACKED:  # then pairs and bands are numbered as they occur, and keys are bounded by the hits
        numbers, pair = np.unique(pair, return_inverse=True)
    cells = pair * bands + band
    if numbers is None:
        keys = cells * longest + place
        keys = np.sort(np.concatenate((keys, keys - longest)))
        keys = keys[np.diff(keys, prepend=-1) > 0] // longest
        begins = np.flatnonzero(np.diff(keys, prepend=-1) > 0)
        cells, counts = keys[begins], np.diff(np.append(begins, len(keys)))
        return cells // bands, cells % bands, counts
    cells, cell = np.unique(np.concatenate((cells, cells - 1)), return_inverse=True)
    counts = np.bincount(np.unique(cell * longest + np.concatenate((place, place))) // longest, minlength=len(cells))
    return numbers[cells // bands], cells % bands, counts


def matches(data: np.ndarray, offsets: np.ndarray, index: ItemIndex, q: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, edits, start, end) of the best place of each item in each row; start and end are bytes of ``data``."""
    text, at, place = normalized(data, offsets)
    best: dict[tuple[int, int], tuple[int, int, int]] = {(r, i): (0, int(place[a]), int(place[b - 1]) + 1) for r, i, a, b in _short_matches(text, at, index)}
    if len(text) >= q and len(index.grams):
        _long_matches(text, at, place, index, q, best)
    for (r, i), (edits, begin, end) in sorted(best.items()):
        yield r, i, edits, begin - int(offsets[r]), end - int(offsets[r])


def _runs(before: np.ndarray, at: np.ndarray, reach: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, begin, end): runs of rows, and parts of a row, with about ``HITS`` places in each.

    ``before[k]`` is the number of places that begin before byte ``k``. Parts of a row overlap by ``reach``, so what is not longer
    lies in one of them.
    """
    row, rows = 0, len(at) - 1
    while row < rows:
        last = int(np.searchsorted(before[at], before[at[row]] + HITS, side="right")) - 1
        if last > row:
            yield row, min(last, rows), int(at[row]), int(at[min(last, rows)])
            row = min(last, rows)
            continue
        begin, end = int(at[row]), int(at[row + 1])
        while begin < end:
            cut = max(int(np.searchsorted(before, before[begin] + HITS, side="right")) - 1, begin + 1)
            yield row, row + 1, begin, min(cut + reach, end)
            begin = end if cut + reach >= end else cut
        row += 1


def _long_matches(text: np.ndarray, at: np.ndarray, place: np.ndarray, index: ItemIndex, q: int, best: dict[tuple[int, int], tuple[int, int, int]]) -> None:
    """Puts (edits, start, end) of the best place of each item of ``q`` bytes and more in each row into ``best``."""
    grams = packed(text, q)
    hit = np.flatnonzero(index.present[_slot(grams)])
    found = np.minimum(np.searchsorted(index.grams, grams[hit]), len(index.grams) - 1)
    same = index.grams[found] == grams[hit]
    hit, found = hit[same], found[same]
    places = np.zeros(len(text) + 1, np.int64)
    places[hit + 1] = index.first[found + 1] - index.first[found]
    reach = max(map(len, index.items)) + int(index.edits.max()) + 1
    for first, last, begin, end in _runs(np.cumsum(places), at, reach):
        some = slice(int(np.searchsorted(hit, begin)), int(np.searchsorted(hit, end)))
        part: dict[tuple[int, int], tuple[int, int, int]] = {}
        borders = np.clip(at[first : last + 1], begin, end) - begin
        _run_matches(text[begin:end], borders, place[begin:end], hit[some] - begin, found[some], index, q, part)
        for (r, i), spot in part.items():
            if (r + first, i) not in best or spot < best[r + first, i]:
                best[r + first, i] = spot


def _run_matches(
    text: np.ndarray, at: np.ndarray, place: np.ndarray, hit: np.ndarray, found: np.ndarray, index: ItemIndex, q: int, best: dict[tuple[int, int], tuple[int, int, int]]
) -> None:
    """:func:`_long_matches` of a run of rows: ``hit`` has the places of known q-grams, ``found`` their numbers."""
    row = np.searchsorted(at, hit, side="right") - 1
    within = hit + q <= at[np.minimum(row + 1, len(at) - 1)]
    hit, found, row = hit[within], found[within], row[within]
    if not len(hit):
        return
    n = index.first[found + 1] - index.first[found]
    post = np.repeat(index.first[found] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    item, row = index.item[post], np.repeat(row, n)
    step = index.edits[item] + 1
    # Diagonals count from far enough before the row's first byte that no band is negative.
    base = 4 * max(map(len, index.items))
    bands = len(text) + 2 * base
    diagonal = np.repeat(hit, n) - at[row] - index.place[post] + base
    band = diagonal // step
    # A q-gram of the item counts once in a band, however often the text repeats it.
    longest = base // 4 + 1
    pair, band, counts = _counted(row * len(index.items) + item, band, index.place[post], len(at) * len(index.items), bands, longest)
    item, row = pair % len(index.items), pair // len(index.items)
    for k in np.flatnonzero(counts >= index.needed[item]):
        i, r = int(item[k]), int(row[k])
        e, wanted = int(index.edits[i]), index.items[i]
        low = int(band[k]) * (e + 1) - base  # diagonals low .. low + 2e + 1, and e more to either side
        start = max(0, low - e)
        region = text[at[r] + start : min(at[r + 1], at[r] + low + 2 * (e + 1) + len(wanted) + e)].tobytes()
        exact = region.find(wanted)
        if exact >= 0:
            edits, begin, end = 0, exact, exact + len(wanted)
        else:
            edits, end = aligned(wanted, region, low - e - start, 4 * e + 2)
            if edits > e:
                continue
            back = region[:end][::-1]
            begin = end - aligned(wanted[::-1], back, -e, 2 * e + 1)[1]
        spot = (edits, int(place[at[r] + start + begin]), int(place[at[r] + start + end - 1]) + 1)
        if (r, i) not in best or spot < best[r, i]:
            best[r, i] = spot


def _passes(benchmark: DataFrame, q: int, rate: float) -> Iterator[Callable[[], ItemIndex]]:
    """The benchmark in parts of bounded size, each read when it is called: one part is with the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // PASS_BYTES)

    def read(k: int) -> ItemIndex:
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        return ItemIndex.of(sorted((r.item_id if r.item_id is not None else -1, r.text) for r in part.collect()), q, rate)

    for k in range(n):
        yield lambda k=k: read(k)


def contamination(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """``doc_id, item_id, edits, start_byte, end_byte``: each item found in each row of ``docs``, at its best place.

    Whole texts; null and empty texts have no matches. Items shorter than ``q`` bytes are found as they are, without
    edits; null and empty ones are not looked for. An item without id is reported as -1. Each repeated row is reported. An empty benchmark gives no rows.
    """

    def search(index: ItemIndex):
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                rows = list(matches(*text_buffers(part.column("text")), index, q))
                r, i, edits, start, end = zip(*rows, strict=True) if rows else [()] * 5
                columns = [part.column("doc_id").take(pa.array(r, pa.int64())), *(pa.array(c, pa.int64()) for c in ([index.ids[k] for k in i], edits, start, end))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "edits", "start_byte", "end_byte"])

        return read

    schema = "doc_id long, item_id long, edits long, start_byte long, end_byte long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    parts = list(_passes(benchmark, q, rate))
    for part in parts:
        passed = texts.mapInArrow(search(part()), schema)
        # Of several passes each is run and written by itself, so that the items of one are in a task at a time.
        found = found.unionByName(durable(passed) if len(parts) > 1 else passed)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE) -> DataFrame:
    """The rows of ``docs`` in which no item of ``benchmark`` is found, all columns kept."""

    def search(index: ItemIndex):
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                keep = np.ones(part.num_rows, bool)
                for r, *_ in matches(*text_buffers(part.column("text")), index, q):
                    keep[r] = False
                yield part.filter(pa.array(keep))

        return read

    parts = list(_passes(benchmark, q, rate))
    for part in parts:
        docs = docs.mapInArrow(search(part()), docs.schema)
        docs = durable(docs) if len(parts) > 1 else docs
    return docs
