"""Vector codes: the whole result against plain loops over Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

from reelsift.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, entry int, n int, part string, _0 int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, 2, "y", 3) for i, v, label in rows], SCHEMA).repartition(3)


def plain(rows, entries=256, rounds=4):
    """Codes, errors and label errors by nothing but loops."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    width = len(kept[0][1]) // 4
    parts = [[v[p * width : (p + 1) * width] for _, v, _ in kept] for p in range(4)]
    book = [list(parts[p][:entries]) for p in range(4)]

    def nearest(part, codebook):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(codebook))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for part in parts[p]:
                members[nearest(part, book[p])[1]].append(part)
            for k, own in members.items():
                book[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(parts[p][k], book[p]) for p in range(4)] for k in range(len(kept))]
    told = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), label) for (i, _, label), f in zip(kept, found, strict=True)]
    total = defaultdict(int)
    for _, _, error, label in told:
        total[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    return sorted(((i, code, error, total[label]) for i, code, error, label in told), key=repr), digest


def vectors(n, width=16, spread=1.0, seed=3):
    rng = random.Random(seed)
    as_float = lambda x: float(__import__("numpy").float32(x))
    return [(k, [as_float(rng.gauss(0, spread)) for _ in range(width)], rng.choice([0, 1, 2, None])) for k in range(n)]


ODD = [
    (900, None, 1), (901, [0.5] * 15 + [None], 1), (902, [0.5] * 15 + [float("nan")], 1), (903, [0.5] * 15 + [float("inf")], 2), (904, [0.0] * 16, None),
    (905, [-0.0005] * 16, 1), (7, [0.25] * 16, 1), (7, [0.25] * 16, 1), (None, [0.75] * 16, 1),
]


def check(spark, rows, entries=256):
    found = vector_codes.codes_with_label_errors(frame(spark, rows), entries=entries)
    got = found.collect()
    want, digest = plain(rows, entries)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=repr) == want
    assert {r.codebooks_sha256 for r in got} <= {digest}


@pytest.mark.parametrize("entries", [8, 256])
def test_codes_equal_plain_rounds(spark, entries):
    check(spark, vectors(300) + ODD, entries)


def test_hot_vectors_ties_and_salts(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "OWNED", 10)
    hot = [(1000 + k, [0.5, -0.5] * 8, k % 2) for k in range(150)]
    check(spark, vectors(150, spread=0.002) + hot, 16)


def test_large_components_are_exact(spark):
    check(spark, vectors(60, spread=20_000.0), 8)


def test_few_and_no_vectors(spark):
    check(spark, vectors(5))
    check(spark, [(1, [], 0), (2, [], None)])
    empty = vector_codes.codes_with_label_errors(frame(spark, []))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
    assert vector_codes.codes_with_label_errors(frame(spark, ODD[:4])).count() == 0


def test_only_changed_members_move(spark):
    rows = frame(spark, vectors(200)).selectExpr("vec_id", "embedding AS vector")
    book = vector_codes._first_codebook(rows, "vec_id", 8, 4, 1024)
    state = vector_codes._placed(rows.select("vector"), book, 4, 1024, 2, 4)
    assert vector_codes._assigned(state, book).where("home != entry").count() == 0
    moved = vector_codes._assigned(state, vector_codes._updated(state, book)).where("home != entry").count()
    assert 0 < moved < state.count() / 2


def test_refused(spark):
    for rows in ([(1, [0.0] * 6, 0)], [(1, [0.0] * 4, 0), (2, [0.0] * 8, 0)], [(1, [1e9] * 4, 0)]):
        with pytest.raises(Exception, match="length|equal parts|beyond"):
            vector_codes.codes_with_label_errors(frame(spark, rows)).collect()
