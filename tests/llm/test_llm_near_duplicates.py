"""The n-gram Jaccard join against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from reelsift.llm import common, near_duplicates
from reelsift.llm.components import connected_components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def expected(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [[] for _ in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a].append(b)
            links[b].append(a)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            todo += [x for x in links[todo.pop()] if x not in seen and not seen.add(x)]
        out.append((rows[k][0], min(rows[x][0] for x in seen), len(links[k])))
    return sorted(out)


def edited(text, rng, times):
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    rng = random.Random(3)
    rows, passage = [], prose(60, 77)
    for k in range(60):
        base = prose(rng.randint(3, 200), 100 + k)
        rows.append(base)
        rows += [edited(base, rng, rng.randint(1, 6)) for _ in range(rng.randint(0, 3))]
        if k % 4 == 0:
            rows += [base, passage + " " + base]
    return list(enumerate(rows))


def result(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_links_and_classes(make_docs, prose):
    rows = corpus(prose)
    want = expected(rows)
    assert sum(r[2] for r in want) > 100
    assert result(near_duplicates.near_duplicates(make_docs(rows))) == want


def test_crowded_groups_in_blocks(make_docs, prose, monkeypatch):
    monkeypatch.setattr(near_duplicates, "PAIRED", 6)
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    rng = random.Random(9)
    base = prose(60, 5)
    rows = [base, *(edited(base, rng, rng.randint(1, 3)) for _ in range(60)), *(prose(60, 500 + k) for k in range(10))]
    rows = list(enumerate(rows))
    assert result(near_duplicates.near_duplicates(make_docs(rows))) == expected(rows)


def test_odd_rows(odd_docs):
    got = {(r.doc_id, r.n_links, r.class_id) for r in near_duplicates.near_duplicates(odd_docs).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 1, 5), (6, 1, 5), (7, 1, 7), (None, 0, None)} <= got
    kept = near_duplicates.one_of_each_class(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 7, 8, 8, 9] and ids.count(None) == 2


def test_empty_table(odd_docs):
    assert near_duplicates.near_duplicates(odd_docs.limit(0)).count() == 0
    assert near_duplicates.one_of_each_class(odd_docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}


def test_shingle_sets_follow_the_words():
    texts = ["a b c d e f", "a b", "", None, " \t\n ", "a b c d e f a b c d e", "f", "fa b c d e"]
    tokens, offsets = common.shingle_sets(*common.text_buffers(pa.array(texts)))
    assert np.diff(offsets).tolist() == [len(shingles(t)) for t in texts]
    sets = [set(tokens[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])]
    for (i, x), (j, y) in itertools.combinations(enumerate(texts), 2):
        assert len(sets[i] & sets[j]) == len(shingles(x) & shingles(y))


def test_pruning_bound_only_rises_with_tolerance():
    strict, loose = near_duplicates.least_matches(tolerance=1e-12), near_duplicates.least_matches(tolerance=1e-2)
    assert all(a <= b for a, b in zip(strict, loose)) and strict[-1] > 0


def thue_morse(n, flip=0):
    return "".join("ab"[(k.bit_count() + flip) % 2] for k in range(n))


@pytest.mark.parametrize("n", [64, 1032, 2048])
def test_words_alike_under_polynomial_hashes_are_no_link(make_docs, n):
    rows = [(1, f"one two three four {thue_morse(n)} six seven"), (2, f"one two three four {thue_morse(n, 1)} six seven"), (3, thue_morse(n)), (4, thue_morse(n, 1))]
    got = near_duplicates.near_duplicates(make_docs(rows)).collect()
    assert {(r.doc_id, r.class_id, r.n_links, r.copy_of) for r in got} == {(k, k, 0, k) for k in (1, 2, 3, 4)}


def test_different_sets_with_one_hash_are_told_apart(make_docs, prose, monkeypatch):
    plain = near_duplicates.set_hashes

    def clashing(tokens, offsets, seed=0):
        out = plain(tokens, offsets, seed)
        return np.where(out == 0, out, out % np.uint64(3) + np.uint64(1)) if seed == 0 else out

    monkeypatch.setattr(near_duplicates, "set_hashes", clashing)
    rows = [(k, prose(30, k // 2)) for k in range(20)]
    assert result(near_duplicates.near_duplicates(make_docs(rows))) == expected(rows)


def test_large_groups_are_cut_by_size(make_docs, prose, monkeypatch):
    # A passage that all share makes one group of texts of very different lengths.
    monkeypatch.setattr(near_duplicates, "PAIRED", 4)
    monkeypatch.setattr(near_duplicates, "BLOCK", 6)
    monkeypatch.setattr(near_duplicates, "SENT_SETS", 0)
    monkeypatch.setattr(near_duplicates, "SENT_IDS", 0)
    rng = random.Random(2)
    passage = prose(10, 1)
    rows = [f"{passage} {prose(rng.choice([2, 8, 30, 90]), k // 3)}" for k in range(90)]
    rows = list(enumerate(edited(r, rng, 1) if k % 3 == 2 else r for k, r in enumerate(rows)))
    assert result(near_duplicates.near_duplicates(make_docs(rows))) == expected(rows)


def test_pruned_pairs_are_not_compared(monkeypatch):
    one, other = np.arange(1000, dtype=np.uint64), np.arange(500, 1500, dtype=np.uint64)
    values = np.stack([near_duplicates.minhashes(common.mixed(x)) for x in (one, other, one)])
    i, j = np.array([0, 0, 1]), np.array([1, 2, 2])
    assert near_duplicates.can_reach(values, values, near_duplicates.least_matches(), i, j).tolist() == [1]


def test_columns_called_like_the_operators_own(make_docs, prose):
    docs = make_docs([(1, prose(30, 1)), (2, prose(30, 1)), (3, prose(30, 2)), (None, None)])
    named = docs.withColumnsRenamed({"lang": "_keep", "source": "_nth", "k": "_key", "n": "class_id", "s": "n_links"})
    kept = near_duplicates.one_of_each_class(named)
    assert kept.columns == named.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3]
    assert {(r["_keep"], r["_nth"]) for r in kept.collect()} == {("en", "a")}


def test_counts_of_shingles_need_little_memory():
    import tracemalloc

    draw = np.random.default_rng(5)
    parts = [draw.integers(0, 1 << 21, 100_000).astype(np.uint64) for _ in range(24)]
    tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
    found, times = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    tracemalloc.start()
    for k in range(0, 24, 4):
        found, times = near_duplicates.counted(found, times, [p.copy() for p in parts[k : k + 4]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == tokens).all() and (times == counts).all()
    assert peak < 60 << 20  # all at once: some 120 MB
    same = near_duplicates.counted(found, times, [])
    assert same[0] is found and len(near_duplicates.counted(found[:0], times[:0], [found[:0]])[0]) == 0
