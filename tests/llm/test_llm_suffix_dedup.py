"""Removal of repeated byte strings against brute force."""

import hashlib
import random

import numpy as np

from reelsift.llm import suffix_dedup


def expected(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            if raw[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(raw[p : p + 100])
        spans = bytes(b"\0" + gone).count(b"\0\1")
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def corpus(prose):
    rng = random.Random(4)
    passage = prose(80, 50)
    rows = []
    for k in range(70):
        text = prose(rng.randint(1, 150), 900 + k)
        if k % 3 == 0:
            at = rng.randrange(len(text))
            text = text[:at] + passage[rng.randrange(50) : -rng.randrange(1, 50)] + text[at:]
        if k % 7 == 0 and rows:
            old = rng.choice(rows)
            cut = rng.randrange(len(old) + 1)
            text = old[:cut] + "é" + old[cut:]
        if k % 11 == 0:
            text += "ab " * rng.randint(30, 200)
        rows.append(text)
    return list(enumerate([*rows, rows[3], "", None, "z" * 700]))


def test_removed_bytes(make_docs, prose):
    rows = corpus(prose)
    want = expected(rows)
    assert sum(r[2] for r in want) > 5000
    assert result(suffix_dedup.digests(make_docs(rows))) == want


def test_many_small_collections_and_crowded_keys(make_docs, prose, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "COLLECTION_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "CROWDED", 3)
    monkeypatch.setattr(suffix_dedup, "COMBINED", 50)
    monkeypatch.setattr(suffix_dedup, "SENT_IDS", 1)
    rows = corpus(prose)
    assert result(suffix_dedup.digests(make_docs(rows))) == expected(rows)


def test_sorted_collection_is_a_suffix_array():
    rng = random.Random(2)
    for length in (2, 3, 5, 9):
        for _ in range(10):
            texts = ["".join(rng.choice("ab") for _ in range(rng.randint(length, 3 * length))) for _ in range(rng.randint(1, 7))]
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            places, common = suffix_dedup.sorted_collection(np.frombuffer("".join(texts).encode(), np.uint8), offsets, length)
            suffixes = sorted((t[k:], i, int(offsets[i]) + k) for i, t in enumerate(texts) for k in range(len(t) - length + 1))
            assert places.tolist() == [s[2] for s in suffixes]
            same = [False] + [a[0][:length] == b[0][:length] for a, b in zip(suffixes, suffixes[1:])]
            assert (common >= length).tolist() == same


def test_odd_rows(odd_docs):
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.digests(odd_docs).collect()]
    by = {i: (n, gone) for i, n, gone in got if i not in (7, 8, None)}
    assert len(got) == odd_docs.count() and by[1] == by[2] == (0, 0) and by[5][1] == 0 and by[6][0] == by[6][1]
    # Two equal rows are one document: each keeps what the other does.
    assert [g for g in got if g[0] == 7] == [(7, 5000, 4999)] * 2 or [g for g in got if g[0] == 7] == [(7, 5000, 4900)] * 2


def test_empty_table(odd_docs):
    assert suffix_dedup.digests(odd_docs.limit(0)).count() == 0


def test_spans_restore_the_text(make_docs, prose):
    rows = corpus(prose)[:20]
    for r in suffix_dedup.without_repeats(make_docs(rows)).collect():
        raw = (dict(rows)[r.doc_id] or "").encode()
        spans = list(zip(r.spans[::2], r.spans[1::2]))
        at, rest = 0, []
        for a, b in spans:
            rest.append(raw[at:a])
            at = b
        assert b"".join([*rest, raw[at:]]) == bytes(r.kept)
