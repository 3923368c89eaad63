"""Repair of a conversation's structure by the cheapest edits, in linear space.

A repaired conversation is empty, or alternates user and assistant turns, ending with an assistant, after at most one system
turn. A row is kept (K, free), given the role user or assistant (R, 2) or deleted (D, 3); turns without text can be
inserted (I, 2). Blank and repeated rows must go; a truncated one that stays costs 1. Of several cheapest edits the ones
whose initials are least in ASCII are taken.

What matters of the turns so far is one of four states: none, system, user or assistant last. So the rows' costs are
matrices of four by four, which compose. Hirschberg's method finds the states between the rows: a forward vector of
costs over the first half and a backward one over the second meet in the middle, the cheapest crossing is fixed, and both
halves are solved on their own. Edits up to a border always end with the edit of a row, so no state's edits are the
beginning of another's, and the ranks that go along with the forward costs tell which of several crossings is least.

Rows are range-partitioned by conversation and turn and cut into blocks of at most ``BLOCK`` rows. A conversation of many
blocks, which may hold any share of all rows, is solved over the blocks' matrices in a tree of bounded fan-out, from which
every block gets the state it begins and ends in; blocks are then solved for themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.common import ranges_for
from reelsift.session import durable

#: Rows of a block, and matrices that are composed at a time.
BLOCK, FAN = 4096, 1024
NONE, SYSTEM, USER, ASSISTANT = range(4)
_CLASSES = {"s": 0, "u": 1, "a": 2}
FINE, BLANK, REPEATED, TRUNCATED = range(4)
INSERTED = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
_NEVER = 1 << 60
#: What it costs to end in each state, and the edits that do it.
CLOSING = ((0, ""), (4, "II"), (2, "I"), (0, ""))
END = -1

Matrix = tuple[tuple[tuple[int, int], ...], ...]  # [from][to] = cost, rank among the ways from there
Vector = tuple[tuple[int, int], ...]  # [state] = cost, rank


def _ranked(options: list[tuple]) -> tuple[tuple[int, int], ...]:
    """(cost, rank) of four (cost, order) pairs."""
    order = sorted((o[1], k) for k, o in enumerate(options) if o[0] < _NEVER)
    rank = {k: n for n, (_, k) in enumerate(order)}
    return tuple((o[0], rank.get(k, 4)) for k, o in enumerate(options))


@lru_cache(maxsize=None)
def row_edits(kind: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """``[from][to]``: the cost of one row's cheapest edits, with the insertions before it, and the initials of these."""
    role, fault = divmod(kind, 4)
    out = []
    for begin in range(4):
        best: list[tuple[int, str]] = [(_NEVER, "")] * 4
        state, cost, letters = begin, 0, ""
        for _ in range(3):  # after two insertions states repeat
            ways = [(state, 3, "D")]
            if fault not in (BLANK, REPEATED):
                more = int(fault == TRUNCATED)
                ways.append((INSERTED[state], 2 + more, "R"))
                if role == 0 and state == NONE:
                    ways.append((SYSTEM, more, "K"))
                elif role == 1 and state != USER:
                    ways.append((USER, more, "K"))
                elif role == 2 and state == USER:
                    ways.append((ASSISTANT, more, "K"))
            for end, price, letter in ways:
                best[end] = min(best[end], (cost + price, letters + letter))
            state, cost, letters = INSERTED[state], cost + 2, letters + "I"
        out.append(tuple(best))
    return tuple(out)


@lru_cache(maxsize=None)
def row_matrix(kind: int) -> Matrix:
    return tuple(_ranked([(c, s) for c, s in ways]) for ways in row_edits(kind))


def composed(first: Matrix, second: Matrix) -> Matrix:
    return tuple(forward(row, second) for row in first)


def forward(vector: Vector, matrix: Matrix) -> Vector:
    """The costs, and ranks of the least edits, after one more row or block."""
    best: list[tuple] = [(_NEVER, ())] * 4
    for state, (cost, rank) in enumerate(vector):
        if cost < _NEVER:
            for end, (more, order) in enumerate(matrix[state]):
                if more < _NEVER:
                    best[end] = min(best[end], (cost + more, (rank, order)))
    return _ranked(best)


def backward(costs: tuple[int, ...], matrix: Matrix) -> tuple[int, ...]:
    return tuple(min(min(more + costs[end], _NEVER) for end, (more, _) in enumerate(ways)) for ways in matrix)


@lru_cache(maxsize=1 << 16)
def _forward_row(vector: Vector, kind: int) -> Vector:
    # Only differences matter, so few vectors ever occur.
    after = forward(vector, row_matrix(kind))
    least = min(c for c, _ in after)
    return tuple((c - least if c < _NEVER else c, r) for c, r in after)


@lru_cache(maxsize=1 << 16)
def _backward_row(costs: tuple[int, ...], kind: int) -> tuple[int, ...]:
    after = backward(costs, row_matrix(kind))
    least = min(after)
    return tuple(c - least if c < _NEVER else c for c in after)


def _least(vector: Vector, costs: tuple[int, ...]) -> int:
    return min(range(4), key=lambda s: (min(vector[s][0] + costs[s], _NEVER), vector[s][1]))


def crossings(chain, begin: int, end: int, step, back) -> list[int]:
    """The state after each element of ``chain`` (row kinds or matrices) on the least cheapest way from ``begin`` to ``end``."""
    states = [0] * len(chain)
    last = tuple(c for c, _ in CLOSING) if end == END else tuple(0 if s == end else _NEVER for s in range(4))
    todo = [(0, len(chain), begin, last)]
    while todo:
        low, high, begin, costs = todo.pop()
        if low == high:
            continue
        middle = (low + high + 1) // 2
        vector: Vector = tuple((0, 0) if s == begin else (_NEVER, 4) for s in range(4))
        for k in range(low, middle):
            vector = step(vector, chain[k])
        behind = costs
        for k in range(high - 1, middle - 1, -1):
            behind = back(behind, chain[k])
        state = states[middle - 1] = _least(vector, behind)
        if middle - low > 1:
            todo.append((low, middle - 1, begin, back(tuple(0 if s == state else _NEVER for s in range(4)), chain[middle - 1])))
        todo.append((middle, high, state, costs))
    return states


def _solved(kinds: bytes, begin: int, end: int) -> tuple[str, ...]:
    states = [begin, *crossings(kinds, begin, end, _forward_row, _backward_row)]
    edits = [row_edits(kind)[a][b][1] for kind, a, b in zip(kinds, states[:-1], states[1:], strict=True)]
    return (*edits, CLOSING[states[-1]][1] if end == END else "")


_solved_before = lru_cache(maxsize=1 << 14)(_solved)


def solve(kinds: bytes, begin: int = NONE, end: int = END) -> tuple[str, ...]:
    """The initials of each row's edits (insertions before it first), and of the insertions after the last row."""
    return (_solved_before if len(kinds) <= 32 else _solved)(kinds, begin, end)


def cost_of(kinds: bytes, edits: tuple[str, ...]) -> int:
    prices = {"K": 0, "R": 2, "D": 3, "I": 2}
    kept = sum(kind % 4 == TRUNCATED and not edit.endswith("D") for kind, edit in zip(kinds, edits[:-1], strict=True))
    return kept + sum(prices[letter] for edit in edits for letter in edit)


def illegal_pairs(kinds: bytes) -> int:
    legal = {(0, 1), (1, 2), (2, 1)}
    return sum((a // 4, b // 4) not in legal for a, b in zip(kinds[:-1], kinds[1:], strict=True))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage by CRC-32 of ``conv_id:turn`` modulo 20; a null is one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    harm = F.pmod(F.crc32(F.encode(F.concat(told("conv_id"), F.lit(":"), told("turn")), "UTF-8")), F.lit(20))
    text = told("text")
    rows = turns.select(
        "conv_id", "turn", F.when(harm == 4, F.lit("user")).otherwise(told("role")).alias("role"),
        F.when(harm == 1, F.lit("")).when(harm == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(harm == 0, 0).when(harm == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("time", F.explode(F.array_repeat(F.lit(1), F.col("times")))).select("conv_id", "turn", "role", "text")


def _flags(role: Column, text: Column) -> list[Column]:
    seen = r"[^\x20\x09-\x0D]"
    last = F.regexp_extract(text, rf"({seen})[\x20\x09-\x0D]*\z", 1)
    fault = F.when(~text.rlike(seen), BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    first = F.substring(role, 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return [fault.cast("tinyint").alias("fault"), kind.cast("tinyint").alias("kind")]


def _placed(turns: DataFrame) -> DataFrame:
    """The rows in order: ``conv_id, turn, role, text, kind, fault, digest, block, nth, first``.

    Blocks are numbered in order; ``first`` tells that no row before in the same block has this role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    full = rows.select("conv_id", "turn", "role", "text", *_flags(F.col("role"), F.col("text")), digest.alias("digest"))
    # Short keys, so that the bounds of ranges stay small; the last one parts equal rows, whose order among each other is free.
    keys = ["conv_id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 32), "digest"]
    ranged = full.withColumn("own", F.monotonically_increasing_id()).repartitionByRange(ranges_for(rows, "text"), *keys, "own")
    ordered = ranged.sortWithinPartitions(*keys, "own").select("conv_id", "turn", "role", "text", "kind", "fault", "digest", F.spark_partition_id().alias("part"))
    schema = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, turn {turns.schema['turn'].dataType.simpleString()}, role string, text string"

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, block, nth = object(), set(), -1, 0
        for batch in batches:
            blocks, places, first = [], [], []
            for conversation, key in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                if conversation != current or nth == BLOCK:
                    current, known, block, nth = conversation, set(), block + 1, 0
                blocks.append(block)
                places.append(nth)
                first.append(key not in known)
                known.add(key)
                nth += 1
            numbers = (batch.column("part").to_numpy().astype(np.int64) << 32) + np.array(blocks, np.int64)
            kept = [batch.column(c) for c in ("conv_id", "turn", "role", "text", "kind", "fault", "digest")]
            names = ["conv_id", "turn", "role", "text", "kind", "fault", "digest", "block", "nth", "first"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(numbers), pa.array(places, pa.int32()), pa.array(first, pa.bool_())], names)

    return ordered.mapInArrow(number, f"{schema}, kind byte, fault byte, digest binary, block long, nth int, first boolean")


def _kinds(placed: DataFrame, blocks: DataFrame) -> DataFrame:
    """``block, kinds``: each block's rows as numbers in order, with what is known of repeats in earlier blocks."""
    # Only rows of conversations of several blocks can have been seen in an earlier one. One row per block and text is compared.
    several = blocks.where("blocks > 1").select("block", "conversation")
    wide = placed.where("first").join(several, "block").select("conversation", "block", "nth", "digest")
    earliest = wide.groupBy("conversation", "digest").agg(F.min("block").alias("least"), F.max("block").alias("most")).where("least < most")
    again = durable(wide.join(earliest, ["conversation", "digest"]).where("block > least").select("block", "nth"))
    narrow = placed.select("block", "nth", "kind", F.when((F.col("fault") != BLANK) & ~F.col("first"), REPEATED).otherwise(F.col("fault")).alias("fault"))
    found = again.withColumn("again", F.lit(True))
    marked = narrow.join(found, ["block", "nth"], "left")
    fault = F.when(F.col("again") & (F.col("fault") != BLANK), REPEATED).otherwise(F.col("fault"))
    number = (F.col("kind") * 4 + fault).cast("int")
    return marked.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("nth", number.alias("kind")))).alias("rows")).select("block", F.col("rows.kind").alias("kinds"))


def _summed(kinds: DataFrame) -> DataFrame:
    """``block, kinds, matrix`` and the counts of each block; ``matrix`` has the 16 costs and the 16 ranks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [bytes(k) for k in batch.column("kinds").to_pylist()]
            faults = [np.bincount(np.frombuffer(k, np.uint8) % 4, minlength=4).tolist() for k in rows]
            counts = [[f[n] for f in faults] for n in (BLANK, REPEATED, TRUNCATED)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), pa.array(rows, pa.binary()), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([illegal_pairs(k) for k in rows], pa.int64()), pa.array([k[0] // 4 for k in rows], pa.int32()), pa.array([k[-1] // 4 for k in rows], pa.int32())],
                ["block", "kinds", "blank", "duplicate", "truncated", "illegal", "head", "tail"],
            )

    return kinds.mapInArrow(read, "block long, kinds binary, blank long, duplicate long, truncated long, illegal long, head int, tail int")


def _flat(matrix: Matrix) -> list[int]:
    return [c for row in matrix for c, _ in row] + [r for row in matrix for _, r in row]


def _matrix(flat: list[int]) -> Matrix:
    return tuple(tuple((flat[4 * a + t], flat[16 + 4 * a + t]) for t in range(4)) for a in range(4))


def _begins_and_ends(blocks: DataFrame) -> DataFrame:
    """``block, begin, end`` of the blocks of long conversations (``conversation, nth_block, block, kinds``)."""

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kinds in batch.column("kinds").to_pylist():
                matrix = row_matrix(kinds[0])
                for kind in kinds[1:]:
                    matrix = composed(matrix, row_matrix(kind))
                out.append(_flat(matrix))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conversation"), batch.column("nth_block"), pa.array(out, pa.list_(pa.int64()))], ["conversation", "nth", "matrix"]
            )

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("nth")
        matrices = [_matrix(m) for m in group.column("matrix").to_pylist()]
        whole = matrices[0]
        for matrix in matrices[1:]:
            whole = composed(whole, matrix)
        return pa.table({"conversation": group.column("conversation").slice(0, 1), "nth": group.column("above").slice(0, 1), "matrix": pa.array([_flat(whole)], pa.list_(pa.int64()))})

    def part(group: pa.Table) -> pa.Table:
        group = group.sort_by("nth")
        matrices = [_matrix(m) for m in group.column("matrix").to_pylist()]
        begin, end = group.column("begin")[0].as_py(), group.column("end")[0].as_py()
        after = crossings(matrices, begin, end, forward, backward)
        ends = after if end != END else [*after[:-1], END]
        begins = [begin, *after[:-1]]
        return pa.table({"conversation": group.column("conversation"), "nth": group.column("nth"), "begin": pa.array(begins, pa.int32()), "end": pa.array(ends, pa.int32())})

    level = durable(blocks.select("conversation", "nth_block", "kinds").mapInArrow(of_rows, "conversation long, nth long, matrix array<long>"))
    levels = [level]
    while level.where("nth > 0").limit(1).count():
        above = level.withColumn("above", F.expr(f"nth div {FAN}"))
        level = durable(above.groupBy("conversation", "above").applyInArrow(join, "conversation long, nth long, matrix array<long>"))
        levels.append(level)
    states = level.select("conversation", "nth", F.lit(NONE).alias("begin"), F.lit(END).alias("end"))
    for below in reversed(levels[:-1]):
        parents = states.withColumnRenamed("nth", "above")
        rows = below.withColumn("above", F.expr(f"nth div {FAN}")).join(parents, ["conversation", "above"])
        states = durable(rows.groupBy("conversation", "above").applyInArrow(part, "conversation long, nth long, begin int, end int"))
    return blocks.select("block", "conversation", F.col("nth_block").alias("nth")).join(states, ["conversation", "nth"]).select("block", "begin", "end")


def _edited(blocks: DataFrame) -> DataFrame:
    """``conv_id, block, begin, edits, cost``: the edits of every row of a block, and those after its last one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits, costs = [], []
            for kinds, begin, end in zip(*(batch.column(c).to_pylist() for c in ("kinds", "begin", "end")), strict=True):
                edits.append(solve(kinds, begin, end))
                costs.append(cost_of(kinds, edits[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("block"), batch.column("begin"), pa.array(map(list, edits), pa.list_(pa.string())), pa.array(costs, pa.int64())],
                ["conv_id", "block", "begin", "edits", "cost"],
            )

    kind = blocks.schema["conv_id"].dataType.simpleString()
    return blocks.select("conv_id", "block", "kinds", "begin", "end").mapInArrow(read, f"conv_id {kind}, block long, begin int, edits array<string>, cost long")


class Repair:
    """The tables of one repair: ``placed`` rows, ``blocks`` with their counts, ``edits`` per block."""

    def __init__(self, turns: DataFrame):
        """``turns``: ``conv_id, turn, role, text``; other columns are ignored.

        Rows go by ``turn`` (nulls first), then role and text; equal rows are one after another. A null role or text is one
        space, a null ``conv_id`` a conversation like others. Texts are never cut. The cheapest edits of a
        conversation without rows are none.
        """
        self.placed = durable(_placed(turns))
        by_conversation = Window.partitionBy("conv_id")
        numbered = self.placed.groupBy("conv_id", "block").agg(F.count("*").alias("n_rows"))
        blocks = durable(numbered.select(
            "conv_id", "block", "n_rows", F.min("block").over(by_conversation).alias("conversation"), F.count("*").over(by_conversation).alias("blocks"),
            (F.row_number().over(by_conversation.orderBy("block")) - 1).cast("long").alias("nth_block"),
        ))
        summed = blocks.join(_summed(_kinds(self.placed, blocks)), "block")
        self.blocks = durable(summed)
        short = self.blocks.where("blocks = 1").select("conv_id", "block", "kinds", F.lit(NONE).alias("begin"), F.lit(END).alias("end"))
        long = self.blocks.where("blocks > 1")
        if not long.isEmpty():
            states = _begins_and_ends(long)
            short = short.unionByName(long.join(states, "block").select("conv_id", "block", "kinds", "begin", "end"))
        self.edits = durable(_edited(short))

    def _in_order(self) -> DataFrame:
        """Each block's edits, followed by its rows, conversation by conversation."""
        kind = self.placed.schema["conv_id"].dataType.simpleString()
        none = F.lit(None)
        heads = self.edits.select("conv_id", "block", F.lit(-1).alias("nth"), none.cast("string").alias("role"), none.cast("string").alias("text"), "begin", "edits")
        rows = self.placed.select("conv_id", "block", "nth", "role", "text", none.cast("int").alias("begin"), none.cast("array<string>").alias("edits"))
        both = heads.select(F.col("conv_id").cast(kind).alias("conv_id"), "block", "nth", "role", "text", "begin", "edits").unionByName(rows)
        return both.repartition(ranges_for(self.placed, "text"), "conv_id").sortWithinPartitions("conv_id", "block", "nth")

    def turns(self) -> DataFrame:
        """``conv_id, block, place, role, text, edit`` of the repaired conversations, inserted turns included, in order of block and place."""

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _walked(batches):
                yield pa.RecordBatch.from_pylist([{"conv_id": c, "block": b, "place": p, "role": r, "text": t, "edit": e} for c, b, p, r, t, e in rows], schema)

        ordered = self._in_order()
        kind = ordered.schema["conv_id"].dataType.simpleString()
        schema = pa.schema([("conv_id", _arrow(ordered, "conv_id")), ("block", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        return ordered.mapInArrow(read, f"conv_id {kind}, block long, place long, role string, text string, edit string")

    def digests(self) -> DataFrame:
        """``conv_id, audit, repaired_sha256``; a conversation is read in one task, row by row, and never held whole."""
        ordered = self._in_order()
        kind, arrow = ordered.schema["conv_id"].dataType.simpleString(), _arrow(ordered, "conv_id")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out, current, audit, digest, lines = [], None, [], None, 0

            def told() -> None:
                if digest is not None:
                    out.append({"conv_id": current, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})

            names = pa.schema([("conv_id", arrow), ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for rows in _walked(batches, deleted=True):
                for conversation, _, _, role, text, edit in rows:
                    if digest is None or conversation != current:
                        told()
                        current, audit, digest, lines = conversation, [], hashlib.sha256(), 0
                    audit.append(edit)
                    if edit != "D":
                        digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                        lines += 1
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, names)
                    out = []
            told()
            yield pa.RecordBatch.from_pylist(out, names)

        return ordered.mapInArrow(read, f"conv_id {kind}, audit string, repaired_sha256 string")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _walked(batches: Iterator[pa.RecordBatch], deleted: bool = False) -> Iterator[list[tuple]]:
    """``conv_id, block, place, role, text, edit`` of the turns of rows that follow their block's edits."""
    edits, state, place, pending = [], NONE, 0, None

    def inserted(letters: str) -> Iterator[tuple]:
        nonlocal state, place
        for _ in letters:
            state = INSERTED[state]
            yield (*pending, place, ROLE[state], "", "I")
            place += 1

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "nth", "role", "text", "begin", "edits")]
        for conversation, block, nth, role, text, begin, block_edits in zip(*columns, strict=True):
            if nth < 0:
                if pending is not None:
                    out.extend(inserted(edits[-1]))
                edits, state, place, pending = block_edits, begin, 0, (conversation, block)
                continue
            edit = edits[nth]
            out.extend(inserted(edit[:-1]))
            if edit[-1] == "R":
                state = INSERTED[state]
                role = ROLE[state]
            elif edit[-1] == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            if edit[-1] != "D" or deleted:
                out.append((conversation, block, place, role, text, edit[-1]))
                place += edit[-1] != "D"
        yield out
    if pending is not None:
        yield list(inserted(edits[-1]))


def repair_report(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``turns`` and ``conversations``: counts of faults, the cheapest edits and a digest of the result.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. A conversation without rows has
    zeros, an empty audit and the digest of the empty string.
    """
    repair = Repair(turns)
    pairs = Window.partitionBy("conv_id").orderBy("block")
    before = F.lag("tail").over(pairs)
    legal = ((before == 0) & (F.col("head") == 1)) | ((before == 1) & (F.col("head") == 2)) | ((before == 2) & (F.col("head") == 1))
    faults = repair.blocks.select("conv_id", "blank", "duplicate", "truncated", (F.col("illegal") + F.when(before.isNotNull() & ~legal, 1).otherwise(0)).alias("illegal"))
    spans = repair.placed.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps")
    )
    everyone = turns.select("conv_id") if conversations is None else conversations.select("conv_id")
    tables = [everyone.distinct(), faults, spans, repair.edits.select("conv_id", "cost"), repair.digests()]
    rows = tables[0]
    for table in tables[1:]:
        rows = rows.unionByName(table, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return rows.groupBy("conv_id").agg(
        *[total(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
