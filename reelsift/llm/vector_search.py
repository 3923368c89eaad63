"""Nearest neighbours by largest inner product: p-stable hashing whose tables are probed in order of estimated success.

1. Equal vectors are one from here on, known by the least id that has them; all ids come back at the end. So a vector that
   a third of all rows hold is one row of the index.
2. Largest inner product becomes least distance: a vector gets one more component that brings it to the largest norm of all,
   a query is stretched to that norm and gets 0 there. Neither changes the order of a query's candidates.
3. A table has ``k`` Gaussian projections, cut into cells of width ``w``; a bucket is one cell of each. A neighbour that is not in
   the query's bucket is most likely across the borders that the query is closest to, so the buckets one cell away in some
   projections are visited by the sum of the squared distances to these borders, over all tables together, up to a number of probes.
4. Number of projections, width and number of probes are fitted: on ``SAMPLE`` queries, whose true neighbours are found by
   comparing them with all rows, the fewest estimated comparisons among the settings that find ``RECALL`` of these.
   Only this fit uses a sample. Every vector is in every table.
5. Rows and probes meet by bucket; a bucket of more than ``CHUNK`` rows is split, and its probes go to every piece. A task keeps each
   query's nearest in each piece by exact inner products; these are merged over pieces and tables, and ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelsift.llm.common import mixed, task_partitions
from reelsift.session import durable

NEAREST = 20
TABLES = 4
#: Queries that the settings are fitted on, rows that a bucket's size is estimated from, and what the fit is to find.
SAMPLE, SAMPLE_ROWS, RECALL = 128, 4096, 0.95
#: Settings to choose from: projections of a table, and the width of a cell in units of a neighbour's usual distance.
PROJECTIONS, WIDTHS = (4, 6, 8), (1.5, 2.0, 3.0)
#: A probe's own cost in comparisons, about: it brings the query's vector once more.
PROBE_COST = 300
#: Rows of a piece of a bucket.
CHUNK = 2048
#: Found rows that a task holds.
HELD = 1_000_000
#: Crowded buckets that are sent to all tasks at most; with more, their sizes are joined by a shuffle.
SENT_BUCKETS = 200_000
_ASKED = 512
_SEED = 20


@lru_cache(maxsize=None)
def _cells(k: int) -> np.ndarray:
    """All ways to step -1, 0 or 1 cells in each of ``k`` projections."""
    return np.array(np.meshgrid(*[[-1, 0, 1]] * k, indexing="ij"), np.int8).reshape(k, -1).T.copy()


@dataclass(frozen=True)
class Hashing:
    """The projections of all tables; the same for the same settings. Rows are taken in units of ``norm``."""

    width: int
    k: int
    w: float
    norm: float

    def _projected(self, rows: np.ndarray) -> np.ndarray:
        a, b = _drawn(self.width, self.k, self.w)
        return ((rows @ a + b) / self.w).reshape(len(rows), TABLES, self.k)

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        """Cells of candidates: ``rows x tables x k``."""
        rows = rows / self.norm
        rest = np.sqrt(np.maximum(1 - (rows * rows).sum(1), 0))
        return np.floor(self._projected(np.column_stack((rows, rest)))).astype(np.int64)

    def of_queries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of queries, and how far into its cell each is (0 to 1)."""
        at = self._projected(np.column_stack((_stretched(rows), np.zeros(len(rows)))))
        cells = np.floor(at)
        return cells.astype(np.int64), at - cells

    def scores(self, inside: np.ndarray) -> np.ndarray:
        """For each query the score of every step in every table, least first to be visited: ``queries x (tables * 3**k)``."""
        steps = _cells(self.k)
        out = np.zeros((len(inside), TABLES, len(steps)))
        for j in range(self.k):
            across = np.stack((inside[:, :, j], np.zeros(inside.shape[:2]), 1 - inside[:, :, j]), axis=2) ** 2
            out += across[:, :, steps[:, j] + 1]
        return out.reshape(len(inside), -1)

    def probes(self, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the ``n`` buckets that each query visits, in order of their scores: query numbers and keys."""
        cells, inside = self.of_queries(rows)
        scores = self.scores(inside)
        n = min(n, scores.shape[1])
        first = np.argpartition(scores, n - 1, axis=1)[:, :n]
        first = np.take_along_axis(first, np.argsort(np.take_along_axis(scores, first, 1), axis=1, kind="stable"), 1)
        table, step = np.divmod(first, 3**self.k)
        visited = cells[np.arange(len(rows))[:, None], table] + _cells(self.k)[step]
        return np.repeat(np.arange(len(rows)), n), bucket_keys(visited, table).ravel()


def _norms(rows: np.ndarray) -> np.ndarray:
    most = np.abs(rows).max(1, initial=0)
    return most * np.sqrt(((rows / np.where(most > 0, most, 1)[:, None]) ** 2).sum(1))


def _stretched(rows: np.ndarray) -> np.ndarray:
    return rows / _norms(rows)[:, None]


@lru_cache(maxsize=8)
def _drawn(width: int, k: int, w: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    return rng.standard_normal((width + 1, TABLES * k)), rng.uniform(0, w, TABLES * k)


def bucket_keys(cells: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit keys of buckets; two buckets with one key would only bring more candidates."""
    out = mixed(table.astype(np.uint64) + np.uint64(1))
    for j in range(cells.shape[-1]):
        out = mixed(out * np.uint64(0x2545F4914F6CDD1D) + cells[..., j].astype(np.int64).view(np.uint64))
    return out.view(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _rows(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).astype(np.float64)


def _whole(vectors: DataFrame, kind: str, width: int) -> DataFrame:
    """``id, vector, norm``: rows with an id and a finite vector other than zero, filled up with zeros to ``width`` components."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            lengths = np.asarray(column.value_lengths().fill_null(-1)).astype(np.int64)
            values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
            n = np.maximum(lengths, 0)
            row, at = np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows = np.zeros((len(n), width), kind)
            rows[row, at] = values
            rows += 0.0  # -0.0 is 0.0
            kept = np.flatnonzero((lengths > 0) & np.isfinite(rows).all(1) & rows.any(1) & batch.column("id").is_valid().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(kept)), _binary(rows[kept]), pa.array(_norms(rows[kept].astype(np.float64)))], ["id", "vector", "norm"])

    return vectors.mapInArrow(read, "id long, vector binary, norm double")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, components added one after another, so that equal rows have equal sums wherever they stand."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def _best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``n`` largest inner products of each query with ``rows``, ties to the smaller id: query numbers, row numbers, products."""
    out = []
    for first in range(0, len(queries), _ASKED):
        some = queries[first : first + _ASKED]
        rough = some @ rows.T
        if len(rows) > n:
            last = -np.partition(-rough, n - 1, axis=1)[:, n - 1]
            # What rounding can make of a product is far less than this.
            slack = 1e-12 * rows.shape[1] * np.abs(some).max(1) * np.abs(rows).max()
            q, r = np.nonzero(rough >= (last - slack)[:, None])
        else:
            q, r = (x.ravel() for x in np.indices(rough.shape))
        for begin in range(0, len(q), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            out.append((q[part] + first, r[part], inner_products(some[q[part]], rows[r[part]])))
    q, r, score = (np.concatenate([o[k] for o in out]) for k in range(3))
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < n
    return q[keep], r[keep], score[keep]


@dataclass(frozen=True)
class Settings:
    hashing: Hashing
    probes: int
    #: What the fit's queries find of their true neighbours, and the share of all rows that they are compared with.
    recall: float
    compared: float


def _measured(hashing: Hashing, queries: np.ndarray, whose: np.ndarray, neighbours: np.ndarray, others: np.ndarray, wanted: float) -> Settings | None:
    """The probes that find ``wanted`` of the true neighbours, and the share of ``others`` that they bring; None where no number does."""
    places = 3 ** np.arange(hashing.k - 1, -1, -1)
    tables = np.arange(TABLES) * 3**hashing.k
    cells, inside = hashing.of_queries(queries)
    spots = lambda away: ((np.abs(away) <= 1).all(2), (np.clip(away, -1, 1) + 1) @ places + tables)
    close, at = spots(hashing.of_rows(neighbours) - cells[whose])
    # Buckets that are visited up to and with the one that has the neighbour; a query's scores at a time.
    visits = np.full(len(whose), 1 << 30)
    for q in range(len(queries)):
        mine = np.flatnonzero((whose == q) & close.any(1))
        scores = hashing.scores(inside[q : q + 1])[0]
        needed = np.where(close[mine], scores[at[mine]], np.inf).min(1)
        visits[mine] = np.searchsorted(np.sort(scores), needed, side="right")
    probes = int(np.sort(visits)[min(int(np.ceil(wanted * len(visits))), len(visits)) - 1])
    if probes > TABLES * 3**hashing.k:
        return None
    row_cells, compared = hashing.of_rows(others), 0
    for q in range(len(queries)):
        scores = hashing.scores(inside[q : q + 1])[0]
        limit = np.partition(scores, probes - 1)[probes - 1]
        near, spot = spots(row_cells - cells[q])
        compared += int((near & (scores[spot] <= limit)).sum())
    return Settings(hashing, probes, float((visits <= probes).mean()), compared / (len(queries) * len(others)))


def fit(distinct: DataFrame, kind: str, width: int, nearest: int = NEAREST, wanted: float = RECALL) -> Settings | None:
    """Settings for the vectors of ``distinct`` (``rep``, ``vector``, ``asks``); None where there are none to look for."""
    # No more rows than SAMPLE and SAMPLE_ROWS come to the driver, and no more than 64 MB of vectors.
    bound = max((64 << 20) // (8 * width), 16)
    by_hash = F.xxhash64(F.lit(_SEED), "rep")
    asked = distinct.where("asks").orderBy(by_hash, "rep").limit(min(SAMPLE, bound)).collect()
    if not asked:
        return None
    norm = distinct.agg(F.max("norm")).first()[0]
    told = lambda rows: np.frombuffer(b"".join(bytes(r.vector) for r in rows), kind).reshape(len(rows), width).astype(np.float64)
    queries, own = told(asked), np.array([r.rep for r in asked])
    others = told(distinct.orderBy(by_hash, "rep").limit(min(SAMPLE_ROWS, bound)).collect())
    n = distinct.count()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK):
                part = batch.slice(first, CHUNK)
                rows, ids = _rows(part.column("vector"), kind, width), part.column("rep").to_numpy()
                q, r, score = _best(queries, rows, ids, nearest + 1)
                other = ids[r] != own[q]
                q, r, score = q[other], r[other], score[other]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(score), part.column("rep").take(pa.array(r)), part.column("vector").take(pa.array(r))], ["q", "score", "rep", "vector"])

    found = distinct.select("rep", "vector").mapInArrow(compare, "q long, score double, rep long, vector binary")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "rep"))
    true = found.withColumn("_rank", rank).where(F.col("_rank") <= nearest).drop("_rank").collect()  # SAMPLE x nearest rows
    whose, neighbours = np.array([r.q for r in true], np.int64), told(true)
    if not true:
        return Settings(Hashing(width, PROJECTIONS[0], 4.0, norm), 1, 1.0, 1.0)
    # A neighbour's usual distance, where queries and rows are hashed.
    squares = 2 - 2 * inner_products(_stretched(queries)[whose], neighbours / norm)
    usual = float(np.sqrt(np.maximum(np.median(squares), 1e-12)))
    best = None
    for k in PROJECTIONS:
        for times in WIDTHS:
            found_at = _measured(Hashing(width, k, times * usual, norm), queries, whose, neighbours, others, wanted)
            if found_at is not None:
                cost = found_at.compared * n + found_at.probes * PROBE_COST
                if best is None or cost < best[0]:
                    best = cost, found_at
    if best is None:  # no setting reaches so many: one bucket for all, every query is compared with every row
        return Settings(Hashing(width, PROJECTIONS[0], 1e6, norm), TABLES * 3 ** PROJECTIONS[0], 1.0, float(TABLES))
    return best[1]


def _keyed(distinct: DataFrame, settings: Settings, kind: str, width: int) -> DataFrame:
    """``key, rep, vector``: every vector in its bucket of every table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = settings.hashing.of_rows(_rows(batch.column("vector"), kind, width))
            keys = bucket_keys(cells, np.broadcast_to(np.arange(TABLES), cells.shape[:2]))
            for table in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys[:, table])), batch.column("rep"), batch.column("vector")], ["key", "rep", "vector"])

    return distinct.select("rep", "vector").mapInArrow(read, "key long, rep long, vector binary")


def _probing(distinct: DataFrame, settings: Settings, kind: str, width: int) -> DataFrame:
    """``key, rep, vector``: every query at each bucket that it visits."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                q, keys = settings.hashing.probes(_rows(part.column("vector"), kind, width), settings.probes)
                at = pa.array(q)
                yield pa.RecordBatch.from_arrays([pa.array(keys), part.column("rep").take(at), part.column("vector").take(at)], ["key", "rep", "vector"])

    return distinct.where("asks").select("rep", "vector").mapInArrow(read, "key long, rep long, vector binary")


def _met(together: DataFrame, kind: str, width: int, n: int) -> DataFrame:
    """``query, rep, score`` of rows sorted by piece, a piece's rows (``role`` 0) before its probes: each query's ``n`` nearest in the task.

    What a query has found in several buckets is merged here already, so it leaves the task as ``n`` rows and not as ``n`` a probe.
    """

    def merged(found: list[tuple]) -> tuple[np.ndarray, ...]:
        query, rep, score = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.lexsort((rep, -score, query))
        query, rep, score = query[order], rep[order], score[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (rep[1:] != rep[:-1])  # a row met in two tables has one score
        query, rep, score = query[new], rep[new], score[new]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < n
        return query[keep], rep[keep], score[keep]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, ids, rows = None, np.zeros(0, np.int64), np.zeros((0, width))
        held, n_held = [], 0
        for batch in batches:
            key, salt, role = (batch.column(c).to_numpy() for c in ("key", "salt", "role"))
            reps, vectors = batch.column("rep").to_numpy(), _rows(batch.column("vector"), kind, width)
            changes = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1]) | (role[1:] != role[:-1])) + 1
            for a, b in zip([0, *changes.tolist()], [*changes.tolist(), len(key)], strict=True):
                if role[a] == 0:
                    more = piece == (key[a], salt[a])
                    ids, rows = (np.concatenate((ids, reps[a:b])), np.concatenate((rows, vectors[a:b]))) if more else (reps[a:b], vectors[a:b])
                    piece = (key[a], salt[a])
                elif piece == (key[a], salt[a]):  # else nothing is in the bucket
                    q, r, score = _best(vectors[a:b], rows, ids, n)
                    held.append((reps[a:b][q], ids[r], score))
                    n_held += len(q)
                if n_held > HELD:
                    held = [merged(held)]
                    n_held = len(held[0][0])
                    if n_held > HELD // 2:  # of many queries
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["query", "rep", "score"])
                        held, n_held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], ["query", "rep", "score"])

    return together.mapInArrow(read, "query long, rep long, score double")


def _candidates(distinct: DataFrame, settings: Settings, kind: str, width: int, n: int) -> DataFrame:
    """``query, rep, score``: the nearest ``n`` vectors of each query in every piece of a bucket that it visits."""
    spark = distinct.sparkSession
    keyed = _keyed(distinct, settings, kind, width)
    crowded = durable(keyed.groupBy("key").count().where(F.col("count") > CHUNK).select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("pieces")))
    # Cells are as wide as neighbours are far away, so there are few crowded buckets; they are counted before they are sent.
    n_crowded = crowded.count()
    crowded = F.broadcast(crowded) if n_crowded <= SENT_BUCKETS else crowded
    pieces = F.coalesce("pieces", F.lit(1))
    rows = keyed.join(crowded, "key", "left").withColumn("salt", F.pmod(F.xxhash64("rep"), pieces).cast("int")).withColumn("role", F.lit(0))
    probes = _probing(distinct, settings, kind, width).join(crowded, "key", "left")
    probes = probes.withColumn("salt", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("role", F.lit(1))
    names = ["key", "salt", "role", "rep", "vector"]
    expected = distinct.count() * TABLES * width * int(kind[2]) * 2
    partitions = max(task_partitions(spark), expected // (64 << 20))
    together = rows.select(*names).unionByName(probes.select(*names)).repartition(partitions, "key", "salt").sortWithinPartitions("key", "salt", "role", "rep")
    return _met(together, kind, width, n)


def nearest_neighbours(
    vectors: DataFrame, asks: Callable[[Column], Column] = lambda key: key % 20 == 0, key: str = "vec_id", column: str = "embedding", nearest: int = NEAREST
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id ``asks`` tells, its nearest other rows found.

    ``score`` is the inner product in double precision, nearest first, ties to the smaller id, at most ``nearest`` of
    them. Rows take no part whose id is null, or whose vector is null, empty, zero or has a null or non-finite component. A
    vector that is shorter than the longest counts as filled up with zeros. Of rows that share an id the one whose
    vector is least (by its bytes) takes part. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{column}`").alias("vector"))
    kind = "<f4" if vectors.schema[column].dataType.elementType.simpleString() == "float" else "<f8"
    schema = "query_id long, rank int, vec_id long, score double"
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    if width <= 0:
        return spark.createDataFrame([], schema)
    whole = _whole(rows, kind, width)
    shared = durable(whole.groupBy("id").count().where("count > 1").select("id"))
    if not shared.isEmpty():
        least = whole.join(shared, "id", "left_semi").groupBy("id").agg(F.min(F.struct("vector", "norm")).alias("v")).select("id", "v.vector", "v.norm")
        whole = durable(whole.join(shared, "id", "left_anti").unionByName(least))
    # The vectors are the key, so a hot one is one row per map task; `rep` is the least id that has it.
    grouped = whole.groupBy("vector").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.max(asks(F.col("id"))).alias("asks"), F.max("norm").alias("norm"))
    distinct = durable(grouped)
    settings = fit(distinct, kind, width, nearest)
    if settings is None:
        return spark.createDataFrame([], schema)
    # The nearest n + 1 vectors of a query hold its nearest n + 1 rows, itself among them.
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "rep"))
    top = _candidates(distinct, settings, kind, width, nearest + 1).distinct().withColumn("_rank", best).where(F.col("_rank") <= nearest + 1)
    top = durable(top.select("query", "rep", "score"))
    several = distinct.where("n > 1").select("vector", "rep")
    members = durable(several.join(whole, "vector").select("rep", "id"))
    nth = F.row_number().over(Window.partitionBy("rep").orderBy("id"))
    # Of many rows with one vector, a query can only list the first ones, and all of them when it asks for itself.
    first = members.withColumn("_nth", nth).where(F.col("_nth") <= nearest + 1).select("rep", "id")
    singles = distinct.where("n = 1").select("rep", F.col("rep").alias("id"))
    ids = top.join(first, "rep", "left").select("query", F.coalesce("id", "rep").alias("vec_id"), "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = ids.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= nearest + 1).select("query", F.struct("_place", "vec_id", "score").alias("f"))
    lists = durable(lists.groupBy("query").agg(F.array_sort(F.collect_list("f")).alias("found")))
    queries = singles.unionByName(members).where(asks(F.col("id"))).select(F.col("rep").alias("query"), F.col("id").alias("query_id"))
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, nearest)
    pairs = queries.join(lists, "query").select("query_id", F.posexplode(others).alias("at", "f"))
    return pairs.select("query_id", (F.col("at") + 1).alias("rank"), "f.vec_id", "f.score")
