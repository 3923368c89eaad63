"""Mixing to target weights: targets against a plain solution, and what the mix takes."""

import re
from collections import Counter, defaultdict

import pytest

from reelsift.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0d]+", text or ""))


def targets(sizes, weights, budget, passes=3):
    """Fill up sources one after another and share the rest anew."""
    got, open_ = {}, set(sizes)
    while True:
        rest, w = budget - sum(got.values()), sum(weights[s] for s in open_)
        full = [s for s in open_ if rest * weights[s] / w > passes * sizes[s]] if w else []
        if not full:
            return got | {s: rest * weights[s] / w for s in open_}
        for s in full:
            got[s] = passes * sizes[s]
            open_.remove(s)


def rows_of(prose):
    rows = [(k, prose(1 + k % 37, k), "abcde"[k % 5] if k % 3 else "a") for k in range(600)]
    return [*rows, *((600 + k, prose(9, k), None) for k in range(40)), (700, "", "f"), (701, None, "f"), (702, "one", "\U0001f600"), (703, "one", "￮")]


def test_targets_and_taken_words(make_docs, prose):
    rows = rows_of(prose)
    got = mixing.mix_sources(make_docs(rows)).collect()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weights = {s: k % 3 + 1.0 for k, s in enumerate(order)}
    want = targets(dict(sizes), weights, sum(sizes.values()))
    taken, largest = Counter(), defaultdict(int)
    for r in got:
        assert r.size == words(dict((i, t) for i, t, _ in rows)[r.doc_id]) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert len(got) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 3 * max(largest.values())


def test_reruns_agree_and_seeds_differ(make_docs, prose):
    docs = make_docs(rows_of(prose))
    told = lambda seed: sorted((r.doc_id, r.copies) for r in mixing.mix_sources(docs.repartition(5), seed=seed).collect())
    assert told(1) == told(1) != told(2)


def test_blocks_do_not_change_the_mix(make_docs, prose, monkeypatch):
    docs = make_docs(rows_of(prose))
    told = lambda: sum(r.taken for r in mixing.mix_sources(docs).collect())
    total = told()
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    assert abs(told() - total) <= 37


def test_documents_of_the_mix(make_docs, odd_docs):
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    copies = {(r.doc_id, r.source): r.copies for r in mixing.mix_sources(odd_docs).collect()}
    count = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert all(count[k] % c == 0 for k, c in copies.items() if c) and all(k in copies for k in count)
    assert mixing.mixed_documents(odd_docs.limit(0)).count() == mixing.mix_sources(odd_docs.limit(0)).count() == 0


def test_given_weights_and_budget(spark, make_docs):
    docs = make_docs([(k, "w " * 10, "ab"[k % 2]) for k in range(200)])
    weights = spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double")
    taken = Counter()
    for r in mixing.mix_sources(docs, weights, budget=400).collect():
        taken[r.source] += r.taken
    assert taken == {"a": 300, "b": 100}


def test_no_python_in_the_plan(make_docs):
    plan = mixing.mix_sources(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_columns_called_like_the_operators_own(make_docs, prose):
    docs = make_docs(rows_of(prose)).withColumnsRenamed({"lang": "_shuffled", "n": "_copy", "k": "copies", "s": "target"})
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and {r["_shuffled"] for r in mixed.collect()} == {"en"} and {r["_copy"] for r in mixed.collect()} == {2}
    count = Counter((r.doc_id, r.source) for r in mixed.collect())
    assert count == Counter({(r.doc_id, r.source): r.copies for r in mixing.mix_sources(docs.select("doc_id", "text", "source")).collect() if r.copies})
