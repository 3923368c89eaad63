"""Benchmark items in documents: exact and edited ones, against edit distances computed in full."""

import random

import numpy as np
import pytest

from reelsift.llm import decontamination as dc


def distance_within(item, text):
    """Least edits from the item to a part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, rng, times):
    for _ in range(times):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + "q" + text[at:], text[:at] + text[at + 1 :], text[:at] + "z" + text[at + 1 :]])
    return text


@pytest.fixture(scope="module")
def items(prose):
    return [(k, prose(4 + k % 12, 3000 + k)) for k in range(20)] + [(90, "tiny"), (91, ""), (92, None)]


def test_found_items(spark, make_docs, items, prose):
    rng = random.Random(8)
    rows = []
    for k in range(120):
        text = prose(rng.randint(0, 80), 7000 + k)
        if k % 2:
            item = rng.choice(items[:20])[1]
            item = edited(item, rng, rng.randint(0, 12))
            at = rng.randrange(len(text) + 1)
            text = text[:at] + item + text[at:]
        rows.append((k, text))
    fold = lambda t: dc.normalized(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0].tobytes().strip()
    want = {}
    for i, text in rows:
        for j, item in items[:20]:
            edits = distance_within(fold(item), fold(text))
            if edits <= dc.budget(len(fold(item))):
                want[i, j] = edits
    found = dc.contamination(make_docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in found} == want and len(want) > 20 and max(want.values()) > 3
    kept = dc.without_benchmark(make_docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({i for i, _ in rows} - {i for i, _ in want})
    exact = [r for r in found if r.edits == 0]
    for r in exact:
        part = dict(rows)[r.doc_id].encode()[r.start_byte : r.end_byte]
        assert fold(part.decode()) == fold(dict(items)[r.item_id])


def test_case_and_white_space(spark, make_docs):
    bench = spark.createDataFrame([(1, "Élan vital, the long\nway round the Garden of Eden")], "item_id long, text string")
    docs = make_docs([(1, "xx ÉLAN VITAL,  the long way\t\n round the garden of eden yy"), (2, "the garden of eden")])
    assert [(r.doc_id, r.edits) for r in dc.contamination(docs, bench).collect()] == [(1, 0)]


def test_passes_agree(spark, make_docs, items, monkeypatch):
    docs = make_docs([(k, f"before {t} after") for k, t in items[:20]])
    bench = spark.createDataFrame(items, "item_id long, text string")
    told = lambda: sorted(map(repr, dc.contamination(docs, bench).collect()))
    whole = told()
    monkeypatch.setattr(dc, "PASS_BYTES", 300)
    assert told() == whole and len(whole) >= 20


def test_odd_rows(spark, odd_docs, items):
    bench = spark.createDataFrame([*items, (7, "x" * 60), (7, "x" * 60)], "item_id long, text string")
    found = dc.contamination(odd_docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in found if r.edits == 0].count((7, 7)) == 4
    kept = dc.without_benchmark(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2
    none = bench.limit(0)
    assert dc.contamination(odd_docs, none).count() == 0 and dc.without_benchmark(odd_docs, none).count() == odd_docs.count()
    assert dc.contamination(odd_docs.limit(0), bench).count() == 0


def test_repeated_words_are_not_matches():
    index = dc.ItemIndex.of([(0, "the and the other and the one and the last of the")], dc.Q, dc.EDIT_RATE)
    data = np.frombuffer(b"the and " * 3000, np.uint8)
    assert list(dc.matches(data, np.array([0, len(data)]), index, dc.Q)) == []


def test_many_items_and_a_very_long_one():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    items = [(k, word(24)) for k in range(35_000)] + [(-5, word(200_000))]
    index = dc.ItemIndex.of(items, dc.Q, dc.EDIT_RATE)
    wanted = [rng.randrange(35_000) for _ in range(1_000)]
    texts = [f"{word(10)} {items[k][1][:-1]} {word(10)}".encode() for k in wanted]
    offsets = np.cumsum([0, *map(len, texts)])
    found = [(r, index.ids[i]) for r, i, *_ in dc.matches(np.frombuffer(b"".join(texts), np.uint8), offsets, index, dc.Q)]
    assert found == list(enumerate(wanted))


def test_forms_of_counting_agree(items, prose, monkeypatch):
    index = dc.ItemIndex.of([r for r in items if r[1]], dc.Q, dc.EDIT_RATE)
    texts = [f"{prose(9, k)} {items[k % 20][1]} {prose(9, 50 + k)}".encode() for k in range(60)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    packed = list(dc.matches(data, offsets, index, dc.Q))
    monkeypatch.setattr(dc, "_PACKED", 0)
    assert list(dc.matches(data, offsets, index, dc.Q)) == packed and len(packed) >= 60


def test_items_of_few_bytes(spark, make_docs):
    bench = spark.createDataFrame([(1, "Qed"), (2, "QED "), (3, "x"), (4, "seven 7"), (5, "  ")], "item_id long, text string")
    docs = make_docs([(1, "so  qed, QED"), (2, "q"), (3, "ed"), (4, "é seven \n7"), (5, None), (6, "no")])
    found = sorted((r.doc_id, r.item_id, r.edits, r.start_byte, r.end_byte) for r in dc.contamination(docs, bench).collect())
    assert found == [(1, 1, 0, 4, 7), (1, 2, 0, 4, 7), (4, 4, 0, 3, 11)]
    assert sorted(r.doc_id for r in dc.without_benchmark(docs, bench).collect()) == [2, 3, 5, 6]


def test_runs_of_places_agree(items, prose, monkeypatch):
    index = dc.ItemIndex.of([r for r in items if r[1]], dc.Q, dc.EDIT_RATE)
    texts = [f"{prose(9, k)} {items[k % 20][1]} {prose(9, 50 + k)}".encode() for k in range(30)] + [b"", b"x"]
    texts += [" ".join(f"{prose(30, 900 + k)} {items[k][1]}" for k in range(20)).encode()] * 2
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = list(dc.matches(data, offsets, index, dc.Q))
    assert len(whole) >= 70
    for hits in (1, 60, 1000):
        monkeypatch.setattr(dc, "HITS", hits)
        assert list(dc.matches(data, offsets, index, dc.Q)) == whole


def test_places_of_common_q_grams_are_bounded():
    import tracemalloc

    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(60)]
    items = [(k, " ".join(rng.choices(words, k=30))) for k in range(2_000)]
    index = dc.ItemIndex.of(items, dc.Q, dc.EDIT_RATE)
    text = " ".join(rng.choices(words, k=12_000) + [items[77][1]] + rng.choices(words, k=2_000)).encode()
    tracemalloc.start()
    found = list(dc.matches(np.frombuffer(text, np.uint8), np.array([0, len(text)]), index, dc.Q))
    assert (0, 77, 0) in {f[:3] for f in found} and tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
