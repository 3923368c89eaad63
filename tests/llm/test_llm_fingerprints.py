"""Fingerprints: edited texts, likeness, and the block tables against all pairs."""

import hashlib
import random
import re

import xxhash

from reelsift.llm import fingerprints


def test_edited_texts(make_docs, prose):
    rows = [(k, prose(1 + k * 7 % 60, k)) for k in range(80)] + [(200, ""), (201, "é"), (202, "\U0001f600 b"), (203, None)]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(make_docs(rows)).collect()}
    for k, (i, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)]
        n, beginning = len(text), following[1] or ""
        edited = text[: n - n // 2] + beginning[: n // 2]
        assert (got[i].n_chars, got[i].edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        apart = (got[i].fingerprint ^ got[following[0]].fingerprint) & (2**64 - 1)
        assert got[i].near_next == 1 - apart.bit_count() / 64
    near = [r.near_edited - r.near_next for r in got.values() if r.n_chars > 100]
    assert sum(near) / len(near) > 0.1


def test_equal_texts_and_spaces(make_docs, prose):
    text = prose(30, 1)
    rows = fingerprints.fingerprint_documents(make_docs([(1, text), (2, text), (3, text.replace(" ", "\n\t")), (4, text + " z"), (5, None), (6, "")])).collect()
    f = {r.doc_id: r.fingerprint for r in rows}
    assert f[1] == f[2] == f[3] != f[4] and f[5] == f[6] == 0


def test_odd_rows(odd_docs):
    got = fingerprints.edited_fingerprints(odd_docs).collect()
    assert len(got) == odd_docs.count()
    sevens = [r for r in got if r.doc_id == 7]
    assert sevens[0] == sevens[1]
    assert fingerprints.edited_fingerprints(odd_docs.limit(0)).count() == 0


def test_all_within_the_radius(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(12)} | {0, 1, 2**63, 2**64 - 1}
    signed = {v - 2**64 if v >= 2**63 else v for v in values}
    rows = spark.createDataFrame([(v, 1) for v in signed], "fingerprint long, n long")
    for radius in (0, 2, 3):
        got = sorted((r.wanted, r.fingerprint) for r in fingerprints.within_radius(rows, rows.select("fingerprint"), radius).collect())
        assert got == sorted((a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= radius)


def test_neighbours_are_counted_with_copies(spark):
    rows = spark.createDataFrame([(0, 5), (1, 5), (50, 7), (51, 2**40), (100, -1), (None, 5)], "doc_id long, fingerprint long")
    got = {r.doc_id: r.n_within for r in fingerprints.with_neighbours(rows).collect()}
    # 5 and 7 differ in one bit, 5 and 2**40 in three, 7 and 2**40 in four.
    assert got == {0: 4, 1: None, 50: 3, 51: None, 100: 0, None: None}


def test_no_python_in_the_plan(make_docs):
    plan = fingerprints.edited_fingerprints(make_docs([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def plain_fingerprint(text):
    """Votes of one term after another, with the hash of both words by its own definition."""
    words = [w for w in re.split(r"[\x09-\x0d\x20]+", (text or "").strip(" ")) if w]
    words = words or [""]
    pairs = list(zip(words, words[1:])) + [(words[-1], None)]
    votes, total = [0] * 64, 0
    for a, b in pairs:
        h = 42
        for w in (a, b):
            if w is not None:
                h = xxhash.xxh64_intdigest(w.encode(), seed=h)
        weight = len(a) + len(b or "")
        total += weight
        for bit in range(64):
            votes[bit] += weight * (h >> bit & 1)
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > total)


def test_fingerprints_equal_plain_votes(make_docs, prose):
    texts = [prose(k, k) for k in (1, 2, 3, 7, 40, 400)] + ["", None, " \t\n ", "a", "a a a a", "é\U0001f600 ñ  x\ty", "x" * 3000, " lead and trail \n"]
    got = {r.doc_id: r.fingerprint % (1 << 64) for r in fingerprints.fingerprint_documents(make_docs(list(enumerate(texts)))).collect()}
    for k, text in enumerate(texts):
        assert got[k] == (plain_fingerprint(text) if (text or "").strip(" \t\n\r\v\f") else got[6]), k
