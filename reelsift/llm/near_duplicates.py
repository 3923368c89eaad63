"""Join of documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

1. Documents with the same set are one class from here on; each class is known by a hash of its set. A second hash tells
   whether different sets have the same one; then all is done again with other hashes.
2. Two sets that are similar enough share a shingle among the first fifth of each, in any order that is the same for
   all sets. The order is by hash, with shingles that are frequent in some task's documents last, so common lines
   and passages meet only in sets that consist of little else.
3. Sets that share such a shingle, and whose sizes allow the similarity, are candidates. Where few share it, they are
   paired; a pair is left out where the shingle before is shared as well, since the pair was made there.
4. Bayesian pruning: MinHash values of a pair are compared a few at a time. As soon as the posterior probability that
   the similarity reaches the threshold, given the matches so far and a uniform prior, falls below ``TOLERANCE``,
   the pair is dropped.
5. What is left, together with the sets of each crowded shingle, falls into connected groups. A group is cut by size, since
   sets whose sizes differ too much cannot be similar, and each size into blocks of about ``BLOCK`` sets. A task has two blocks; it
   prunes their pairs in the same way, compares the rest exactly, and returns one row per set: how many
   documents it is linked with, and one set of its class. No group is in one task, and no pairs leave the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.common import fresh, mixed, shingle_sets, slices, task_partitions, text_buffers
from reelsift.llm.components import connected_components
from reelsift.session import durable

WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-9
HASHES, STEP = 64, 8
#: Sets that share a shingle and are paired there; more are compared as a group.
PAIRED = 128
BLOCK = 256
#: A shingle is put last if this many sets of one task's documents have it, and at most so many shingles are.
FREQUENT, MOST_FREQUENT = 4, 200_000
#: Shingles of sets that a task holds before it adds them to its counts.
HELD_SHINGLES = 500_000
#: Documents whose ids are sent to all tasks at most; the texts of more are shuffled.
SENT_IDS = 500_000
#: Sets with copies or links that are sent to all tasks at most.
SENT_SETS = 300_000
_MINHASH = np.frombuffer(mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64)).tobytes(), np.uint64).reshape(HASHES, 2)


def set_hashes(tokens: np.ndarray, offsets: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each set; that of the empty set is 0."""
    salt = mixed(np.array([(seed + 1) % (1 << 64)], np.uint64) * np.uint64(0x5851F42D4C957F2D))[0]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ salt))))
    n = np.diff(offsets).astype(np.uint64)
    return np.where(n == 0, np.uint64(0), mixed(sums[offsets[1:]] - sums[offsets[:-1]] + n))


def minhashes(tokens: np.ndarray) -> np.ndarray:
    """``HASHES`` MinHash values of a set, 8 bits of each; that different ones look the same keeps pairs, it drops none."""
    if not len(tokens):
        return np.zeros(HASHES, np.uint8)
    out = np.empty(HASHES, np.uint64)
    for k in range(HASHES):
        out[k] = (tokens * (_MINHASH[k, 0] | np.uint64(1)) + _MINHASH[k, 1]).min()
    # Of the least values the high bits are all alike.
    return (mixed(out) >> np.uint64(56)).astype(np.uint8)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each ``STEP`` compared values: the matches from which on a pair is kept.

    With a uniform prior the similarity after ``m`` matches of ``n`` is Beta(m + 1, n - m + 1); the chance that it
    is ``threshold`` or more is that of at most ``m`` successes in ``n + 1`` tries at that rate.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def counted(tokens: np.ndarray, counts: np.ndarray, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The sorted ``tokens`` and their ``counts`` with those of ``held`` added, which is emptied.

    Only what is new is sorted, and the counted ones are copied once, so a task needs little more than the counts it keeps.
    """
    if not held:
        return tokens, counts
    new = np.concatenate(held)
    held.clear()
    new.sort()
    first = np.flatnonzero(np.concatenate(([True], new[1:] != new[:-1]))) if len(new) else np.zeros(0, np.int64)
    times = np.diff(first, append=len(new)).astype(np.int32)
    new = new[first]
    del first
    at = np.searchsorted(tokens, new)
    known = np.zeros(len(new), bool)
    inside = at < len(tokens)
    known[inside] = tokens[at[inside]] == new[inside]
    counts[at[known]] += times[known]
    at, new, times = at[~known], new[~known], times[~known]
    return np.insert(tokens, at, new), np.insert(counts, at, times)


def _sets_and_frequent(docs: DataFrame, seed: int) -> DataFrame:
    """Rows of two kinds: 0: ``doc_id``, set, its size, its MinHash values (once in a task), its second hash; 1: a shingle that is frequent in a task, how often."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, held_n = [], 0
        tokens_met, counts_met = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        for part in slices(batches, "text"):
            tokens, offsets = shingle_sets(*text_buffers(part.column("text")), WORDS)
            sets, n = set_hashes(tokens, offsets, seed), np.diff(offsets)
            second = set_hashes(tokens, offsets, -seed - 2)
            values: list[bytes | None] = [None] * len(n)
            for k in range(len(n)):
                if n[k] and int(sets[k]) not in seen:
                    seen.add(int(sets[k]))
                    held.append(tokens[offsets[k] : offsets[k + 1]])
                    held_n += int(n[k])
                    values[k] = minhashes(held[-1]).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(n), np.int8)), part.column("doc_id"), _signed(sets), pa.array(n), pa.array(values, pa.binary()), _signed(second)],
                ["kind", "a", "b", "n", "values", "second"],
            )
            if held_n > HELD_SHINGLES:
                tokens_met, counts_met = counted(tokens_met, counts_met, held)
                held_n = 0
                if len(tokens_met) > 4_000_000:  # what has been met once within so many is not frequent here
                    tokens_met, counts_met = tokens_met[counts_met > 1], counts_met[counts_met > 1]
        tokens_met, counts_met = counted(tokens_met, counts_met, held)
        often = counts_met >= FREQUENT
        m = int(often.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int8)), _signed(tokens_met[often]), pa.array(counts_met[often].astype(np.int64)), pa.array(np.zeros(m, np.int64)), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64())],
            ["kind", "a", "b", "n", "values", "second"],
        )

    return docs.mapInArrow(read, "kind byte, a long, b long, n long, values binary, second long")


def _prefixes(docs: DataFrame, last: np.ndarray, threshold: float, seed: int) -> DataFrame:
    """``token, s, n, prev``: the shingles of each set that similar sets must share one of, with the shingle before it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in slices(batches, "text"):
            tokens, offsets = shingle_sets(*text_buffers(part.column("text")), WORDS)
            sets, n = set_hashes(tokens, offsets, seed), np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            if len(last):
                at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
                order = np.argsort(row * 2 + (last[at] == tokens), kind="stable")
                tokens = tokens[order]
            new = np.zeros(len(n), bool)
            for k in np.flatnonzero(n):
                if int(sets[k]) not in seen:
                    seen.add(int(sets[k]))
                    new[k] = True
            wanted = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
            place = np.arange(len(tokens)) - offsets[row]
            keep = (place < wanted[row]) & new[row]
            prev = np.zeros(len(tokens), np.uint64)
            prev[1:] = tokens[:-1]
            prev[place == 0] = 0
            yield pa.RecordBatch.from_arrays(
                [_signed(tokens[keep]), _signed(sets[row[keep]]), pa.array(n[row[keep]].astype(np.int32)), _signed(prev[keep])], ["token", "s", "n", "prev"]
            )

    return docs.mapInArrow(read, "token long, s long, n int, prev long")


def _meetings(prefixes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, crowded`` of rows sorted by token: candidate pairs, or a crowded token's sets, each with the first of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))
        rest, hub = none, None  # rows of the last token so far; the first set of it, if it is crowded already

        def told(a, b, crowded) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), crowded))], ["a", "b", "crowded"])

        def group(sets, n, prev) -> Iterator[pa.RecordBatch]:
            sets, at = np.unique(sets, return_index=True)
            n, prev = n[at], prev[at]
            if len(sets) > PAIRED:
                yield told(np.full(len(sets) - 1, sets[0]), sets[1:], True)
            elif len(sets) > 1:
                i, j = np.triu_indices(len(sets), 1)
                ok = (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j]) - 1e-9) & ((prev[i] != prev[j]) | (prev[i] == 0))
                yield told(sets[i[ok]], sets[j[ok]], False)

        def small_groups(token, sets, n, prev) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True]))) if len(token) else np.zeros(1, np.int64)
            size = np.diff(cut)
            twos = cut[:-1][size == 2]
            if len(twos):  # by far the most
                x, y = sets[twos], sets[twos + 1]
                small, large = np.minimum(n[twos], n[twos + 1]), np.maximum(n[twos], n[twos + 1])
                ok = (x != y) & (small >= threshold * large - 1e-9) & ((prev[twos] != prev[twos + 1]) | (prev[twos] == 0))
                yield told(np.minimum(x, y)[ok], np.maximum(x, y)[ok], False)
            for k in np.flatnonzero(size > 2):
                part = slice(cut[k], cut[k + 1])
                yield from group(sets[part], n[part], prev[part])

        for batch in batches:
            rows = tuple(np.concatenate((r, batch.column(k).to_numpy(zero_copy_only=False))) for k, r in enumerate(rest))
            if not len(rows[0]):
                continue
            if hub is not None and rows[0][0] != hub[0]:
                hub = None
            begins = int(np.searchsorted(rows[0], rows[0][-1])) if hub is None or rows[0][-1] != hub[0] else 0
            whole, rest = tuple(r[:begins] for r in rows), tuple(r[begins:] for r in rows)
            if hub is not None and begins:
                own = int(np.searchsorted(whole[0], hub[0], side="right"))
                others = np.unique(whole[1][:own])
                others = others[others != hub[1]]
                yield told(np.full(len(others), hub[1]), others, True)
                whole, hub = tuple(r[own:] for r in whole), None
            yield from small_groups(*whole)
            if len(rest[0]) > 4 * PAIRED and (hub is not None or len(np.unique(rest[1])) > PAIRED):
                hub = hub or (rest[0][0], rest[1].min())
                others = np.unique(rest[1])
                others = others[others != hub[1]]
                yield told(np.full(len(others), hub[1]), others, True)
                rest = none
        if hub is not None:
            others = np.unique(rest[1])
            others = others[others != hub[1]]
            yield told(np.full(len(others), hub[1]), others, True)
        else:
            yield from small_groups(*rest)

    return prefixes.mapInArrow(read, "a long, b long, crowded boolean")


def _payloads(docs: DataFrame, seed: int) -> DataFrame:
    """``s, shingles`` of the sets of ``docs``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            tokens, offsets = shingle_sets(*text_buffers(part.column("text")), WORDS)
            sets = set_hashes(tokens, offsets, seed)
            each = [tokens[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([_signed(sets), pa.array(each, pa.binary())], ["s", "shingles"])

    return docs.mapInArrow(read, "s long, shingles binary")


def can_reach(x: np.ndarray, y: np.ndarray, least: list[int], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The places of the pairs ``(i, j)`` of rows of ``x`` and ``y`` that can still reach the threshold after all their values."""
    alive, matches = np.arange(len(i)), np.zeros(len(i), np.int64)
    for k, m in enumerate(least):
        span = slice(k * STEP, (k + 1) * STEP)
        matches[alive] += (x[i[alive], span] == y[j[alive], span]).sum(axis=1)
        alive = alive[matches[alive] >= m]
    return alive


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def _pruned(pairs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """The pairs (``a, b`` and their MinHash values) that can still reach the threshold."""
    least = least_matches(threshold, tolerance)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                each = np.arange(part.num_rows)
                alive = pa.array(can_reach(_values(part.column("ma")), _values(part.column("mb")), least, each, each))
                yield pa.RecordBatch.from_arrays([part.column("a").take(alive), part.column("b").take(alive)], ["a", "b"])

    return pairs.mapInArrow(read, "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of the sets share."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    tokens = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    width = 4096
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (first, first + width))
        m = np.zeros((n, width), np.float32)
        m[row[a:b], column[a:b] - first] = 1
        out += m @ m.T
    return out.astype(np.int64)


def _in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """``members`` (``component, s, n``) once for each task that compares them: with their ``block`` and the task's two, ``i`` and ``j``.

    Sets whose sizes are ``threshold`` apart or less are in one class of sizes or in neighbouring ones.
    """
    step = -math.log(threshold) * (1 + 1e-9)
    size = F.floor(F.log(F.col("n")) / step).cast("int")
    whole = members.groupBy("component").agg(F.count("*").alias("_all"))
    sized = members.join(whole, "component").withColumn("_size", F.when(F.col("_all") > BLOCK, size).otherwise(0))
    counts = durable(sized.groupBy("component", "_size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks")))
    near = counts
    for name, away in (("_below", 1), ("_above", -1)):
        other = counts.select("component", (F.col("_size") + away).alias("_size"), F.col("_blocks").alias(name))
        near = near.join(other, ["component", "_size"], "left")
    rows = sized.join(durable(near), ["component", "_size"])
    name = lambda size, k: size.cast("long") * (1 << 32) + k
    numbers = lambda size, n: F.transform(
        F.filter(F.sequence(F.lit(0), F.coalesce(n, F.lit(0))), lambda k: k < F.coalesce(n, F.lit(0))), lambda k: name(size, k)
    )
    own = name(F.col("_size"), F.pmod(F.xxhash64(F.lit(11), "s"), F.col("_blocks")))
    sizes = F.col("_size")
    others = F.concat(numbers(sizes - 1, F.col("_below")), numbers(sizes, F.col("_blocks")), numbers(sizes + 1, F.col("_above")))
    tasks = F.explode(F.transform(others, lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"))))
    told = rows.withColumn("block", own).withColumn("_task", tasks)
    return told.select(*members.columns, "block", F.col("_task.i").alias("i"), F.col("_task.j").alias("j"))


def _linked(tasks: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``s, links, root`` per set and task: documents linked with it there, and the least set of its class there."""
    least = least_matches(threshold, tolerance)

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        # Rows that repeat a document bring its set twice.
        s, order = np.unique(group.column("s").to_numpy(), return_index=True)
        block, copies = group.column("block").to_numpy()[order], group.column("copies").to_numpy()[order]
        n, values = group.column("n").to_numpy()[order], _values(group.column("values").combine_chunks())[order]
        a, b = np.triu_indices(len(s), 1)
        possible = np.minimum(n[a], n[b]) >= threshold * np.maximum(n[a], n[b]) - 1e-9
        if group.column("i")[0].as_py() != group.column("j")[0].as_py():  # pairs within one block belong to that block's own task
            possible &= block[a] != block[b]
        a, b = a[possible], b[possible]
        alive = can_reach(values, values, least, a, b)
        a, b = a[alive], b[alive]
        linked = np.zeros((len(s), len(s)), bool)
        if len(a):
            raw = group.column("shingles").to_pylist()
            there, at = np.unique(np.concatenate((a, b)), return_inverse=True)
            x, y = at[: len(a)], at[len(a) :]
            shared = overlaps([np.frombuffer(raw[order[k]], np.uint64) for k in there])[x, y]
            ok = shared >= threshold * (n[a] + n[b] - shared) - 1e-9
            linked[a[ok], b[ok]] = linked[b[ok], a[ok]] = True
        root = np.arange(len(s))
        while True:
            near = np.where(linked, root[None, :], len(s)).min(axis=1, initial=len(s))
            new = np.minimum(root, near)
            new = new[new]
            if (new == root).all():
                break
            root = new
        return pa.table({"s": s, "links": (linked * copies[None, :]).sum(axis=1), "root": s[root]})

    return tasks.groupBy("component", "i", "j").applyInArrow(compare, "s long, links long, root long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id, class_id, n_links, copy_of``.

    ``class_id`` is the least ``doc_id`` of the documents connected by links, ``n_links`` the number of other documents
    whose similarity is ``threshold`` or more, ``copy_of`` the least document with the same set. Words are runs of
    bytes other than ASCII white space; a text of one to four words is one shingle. Null, empty and blank texts have
    no shingles and are linked with nothing, not even each other. Rows with the same ``doc_id`` are compared like
    others. Rows without ``doc_id`` are linked with nothing and have a null class.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    unnamed, texts = texts.where("doc_id IS NULL"), texts.where("doc_id IS NOT NULL")
    for seed in count():
        told = durable(_sets_and_frequent(texts, seed))
        documents = told.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("s"), "n", "values", "second")
        sets = documents.where("n > 0").groupBy("s").agg(
            F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"), F.first("n").alias("n"), F.max("values").alias("values"),
            (F.min("second") != F.max("second")).alias("clash"),
        )
        classes = durable(sets)
        if classes.where("clash").isEmpty():
            break
    frequent = told.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).orderBy(F.desc("n"), "a").limit(MOST_FREQUENT).select("a")
    # At most MOST_FREQUENT numbers; an order of the shingles, which never changes the result.
    last = np.sort(np.array([r.a for r in frequent.collect()], np.int64).view(np.uint64))
    prefixes = _prefixes(texts, last, threshold, seed).repartition(max(task_partitions(spark), 1), "token").sortWithinPartitions("token", "s")
    meetings = durable(_meetings(prefixes, threshold).distinct())
    pairs, crowds = meetings.where("NOT crowded").select("a", "b"), meetings.where("crowded").select("a", "b")
    values = classes.select("s", "values")
    with_values = pairs.join(values.toDF("a", "ma"), "a").join(values.toDF("b", "mb"), "b")
    graph = durable(_pruned(with_values.select("a", "b", "ma", "mb"), threshold, tolerance).unionByName(crowds))
    groups = connected_components(graph)
    members = durable(groups.withColumnRenamed("node", "s").join(classes.drop("clash"), "s"))
    # One document of each set brings its shingles.
    ids = members.select(F.col("copy_of").alias("doc_id")).distinct()
    few = members.count() <= SENT_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")
    tasks = durable(_in_blocks(members.drop("copy_of"), threshold))
    # Counted: the tasks' rows are at most a few for each member, except in very large groups.
    tasks = F.broadcast(tasks) if tasks.count() <= SENT_SETS else tasks
    linked = durable(_linked(_payloads(wanted, seed).join(tasks, "s"), threshold, tolerance))
    roots = connected_components(linked.select(F.col("s").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("s").agg(F.sum("links").alias("links"))
    of_class = roots.withColumnRenamed("node", "s").join(classes.select("s", "copy_of"), "s")
    least = of_class.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    of_set = of_class.join(least, "component").select("s", "class_id")
    per_set = durable(classes.join(of_set, "s", "left").join(links, "s", "left").select(
        "s", F.coalesce("class_id", "copy_of").alias("class_id"), "copy_of", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    ).where("n_links > 0"))
    # Only sets of several documents or with links are joined; every other document is its own class.
    # Counted before they are sent, so that the copies of one set need not meet in one task.
    several = F.broadcast(per_set) if per_set.count() <= SENT_SETS else per_set
    joined = documents.select("doc_id", "s").join(several, "s", "left")
    named = joined.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("copy_of", "doc_id").alias("copy_of")
    )
    none = F.lit(None).cast("long")
    return named.unionByName(unnamed.select("doc_id", none.alias("class_id"), F.lit(0).cast("long").alias("n_links"), none.alias("copy_of")))


def one_of_each_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: the one with the least ``doc_id``, all columns kept.

    Documents without words stay, and so do rows without ``doc_id``. Of several linked rows with the ``doc_id`` to keep,
    one stays. Rows that share a ``doc_id`` go together: if one of them is a near duplicate of a smaller ``doc_id``, all do.
    """
    found = near_duplicates(docs, threshold)
    keep, nth, key = (fresh(docs, name) for name in ("_keep", "_nth", "_key"))
    linked = found.where("n_links > 0").groupBy(F.col("doc_id").alias(key)).agg(F.bool_and(F.col("class_id") == F.col("doc_id")).alias(keep))
    named = docs.where("doc_id IS NOT NULL").join(durable(linked), F.col("doc_id").cast("long") == F.col(key), "left").where(F.col(keep).isNull() | F.col(keep))
    numbered = named.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return numbered.where(F.col(keep).isNull() | (F.col(nth) == 1)).select(*columns).unionByName(docs.where("doc_id IS NULL").select(*columns))
