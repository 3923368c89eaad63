"""Nearest vectors: scores and order against all pairs, recall, and the odd rows."""

import math

import numpy as np
import pytest

from reelsift.llm import vector_search

SCHEMA = "vec_id long, embedding array<float>, id long, vector string, rep int, query long, key int, score double, n int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 5.0, 6) for i, v in rows], SCHEMA.replace("float", kind)).repartition(3)


def product(a, b):
    out = 0.0
    for x, y in zip(a, b, strict=False):  # sum() would add more exactly than one after another
        out += x * y
    return out


def nearest(rows, n=20):
    """All pairs, components added one after another."""
    fit = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) + 0.0 for x in v]
            if i not in fit or np.array(v, "<f4").tobytes() < np.array(fit[i], "<f4").tobytes():
                fit[i] = v
    ask = [i for i in fit if i % 20 == 0]
    return {i: sorted((-product(fit[i], v), j) for j, v in fit.items() if j != i)[:n] for i in ask}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert all([rank for rank, _, _ in own] == list(range(1, len(own) + 1)) for own in out.values())
    return {q: [(score, i) for _, score, i in own] for q, own in out.items()}


def recall(got, want):
    return sum(len(set(own) & set(got.get(q, []))) for q, own in want.items()) / max(sum(map(len, want.values())), 1)


def vectors(n, width=24, seed=1, centres=12, length=lambda rng: 1.0):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, width))
    rows = middle[rng.integers(0, centres, n)] + 0.6 * rng.standard_normal((n, width))
    return [(k, (v / np.linalg.norm(v) * length(rng)).astype(np.float32).tolist()) for k, v in enumerate(rows)]


ODD = [
    (5000, None), (5020, []), (5040, [0.0] * 24), (5060, [None] * 24), (5080, [float("nan")] * 24), (5100, [1.0] * 23 + [float("inf")]), (None, [1.0] * 24),
    (5120, [0.5] * 12), (5140, [-0.0] * 23 + [2.0]), (5160, [0.0] * 23 + [2.0]), (5180, [0.1] * 24), (5180, [0.1] * 24), (5180, [0.2] * 24),
]


@pytest.mark.parametrize("length", [lambda rng: 1.0, lambda rng: rng.uniform(0.1, 3.0)])
def test_found_rows_are_the_nearest(spark, length):
    rows = vectors(1500, length=length) + ODD
    got, want = found(vector_search.nearest_neighbours(frame(spark, rows))), nearest(rows)
    assert set(got) == set(want) and all(len(own) == 20 for own in got.values())
    assert recall(got, want) >= 0.9
    exact = {(q, i): s for q, own in nearest(rows, len(rows)).items() for s, i in own}
    assert all(exact[q, i] == score for q, own in got.items() for score, i in own)
    assert all(own == sorted(own) for own in got.values())


def test_copies_and_ties_are_exact(spark):
    rows = vectors(200) + [(1000 + k, [0.25, -0.5] * 12) for k in range(300)] + [(2000 + k, [0.0] * (k % 24) + [1.0] + [0.0] * (23 - k % 24)) for k in range(100)]
    got, want = found(vector_search.nearest_neighbours(frame(spark, rows))), nearest(rows)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q in range(1000, 1300, 20):
        assert got[q] == want[q]


def test_pieces_of_crowded_buckets_change_nothing(spark, monkeypatch):
    rows = vectors(600)
    whole = found(vector_search.nearest_neighbours(frame(spark, rows)))
    monkeypatch.setattr(vector_search, "CHUNK", 7)
    monkeypatch.setattr(vector_search, "SENT_BUCKETS", 3)
    monkeypatch.setattr(vector_search, "HELD", 100)
    assert found(vector_search.nearest_neighbours(frame(spark, rows))) == whole


def test_few_rows(spark):
    rows = vectors(7) + [(20, [1.0] * 24)]
    assert found(vector_search.nearest_neighbours(frame(spark, rows))) == nearest(rows)
    assert found(vector_search.nearest_neighbours(frame(spark, [(0, [1.0, 2.0])]))) == {}
    for none in ([], ODD[:4], [(1, [1.0]), (2, [2.0])]):
        assert vector_search.nearest_neighbours(frame(spark, none)).count() == 0


def test_doubles_keep_their_precision(spark):
    rows = [(k, [1.0 + k * 1e-12, 2.0]) for k in range(40)]
    got = found(vector_search.nearest_neighbours(frame(spark, rows, "double")))
    assert [i for _, i in got[0]] == list(range(39, 19, -1))


def test_probes_are_in_order_of_their_scores():
    hashing = vector_search.Hashing(8, 4, 0.7, 1.0)
    rows = np.random.default_rng(3).standard_normal((5, 8))
    every = vector_search.TABLES * 3**4
    q, keys = hashing.probes(rows, every)
    assert len(set(keys[q == 0].tolist())) == every
    cells, inside = hashing.of_queries(rows)
    assert keys[0] in vector_search.bucket_keys(cells, np.broadcast_to(np.arange(vector_search.TABLES), (5, vector_search.TABLES)))[0]
    assert (np.diff(np.sort(hashing.scores(inside), axis=1)) >= 0).all() and (hashing.probes(rows, 10)[1].reshape(5, 10) == keys.reshape(5, every)[:, :10]).all()


def test_recall_on_the_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    assert recall(found(vector_search.nearest_neighbours(table)), nearest(rows)) >= 0.9
