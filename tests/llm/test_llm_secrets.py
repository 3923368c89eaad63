"""Secrets: the stated patterns against their plain form, and the token-efficiency test."""

import hashlib
import re

import pytest

from reelsift.llm import common, secrets

RANKS, PATTERN = common.vocabulary("byte_bpe_50k.tiktoken"), common.splitting_pattern()
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
KEY = "q8Zp3LxW0vT7rYb2NcK9sD4f"
TEXTS = [
    "token: abc secret: token: abcdefg", 'Api_Key = "abcdef"', "apikey=abcde", "PASSWORD='a.b/c+d=' token=secret=abcdefgh", "toKen = abcdefgh ſecret=abcdefgh",
    "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "xAKIA" + "B2" * 12 + "-", "deadbeef" * 3, "deadbeef" * 2 + "abcdefg", "é\U0001f600 " + "0123456789abcdef" * 2 + " secret:x" + "0f" * 13,
    "sha " + "ab12" * 10, "id 123e4567-e89b-12d3-a456-426614174000", "on 2024-01-02-2024-01-02-2024-01-02", "a " + KEY + " b", "internationalization_and_localization", "", None,
]


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


@pytest.fixture(scope="module")
def found(make_docs):
    rows = list(enumerate(TEXTS))
    return {r.doc_id: r for r in secrets.secrets_per_document(make_docs(rows), RANKS, PATTERN).collect()}


def test_stated_patterns(found):
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        spans = base(text)
        told = ",".join(f"{name}:{a}:{b}" for a, _, b, name in spans)
        r = found[i]
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))
    assert found[4].n_assign == 0 and found[0].n_assign == 0


def test_token_efficiency(found):
    assert found[TEXTS.index("a " + KEY + " b")].spans == f"dense:2:{2 + len(KEY)}"
    clean = ("sha ", "id ", "on ", "internationalization")
    assert all(found[k].n_dense == 0 for k, t in enumerate(TEXTS) if t and t.startswith(clean))


def test_rows_and_redaction(odd_docs, make_docs):
    docs = make_docs([(1, f"use {KEY} or token=abcdefgh."), (2, None), (2, "plain words")])
    rows = {(r.kind, r.value) for r in secrets.find_secrets(docs, RANKS, PATTERN).collect()}
    assert rows == {("dense", KEY), ("assign", "token=abcdefgh.")}
    clean = secrets.redacted(docs, RANKS, PATTERN)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in clean.where("text IS NOT NULL").collect()) == [(1, "use [secret] or [secret]"), (2, "plain words")]
    assert secrets.secrets_per_document(odd_docs, RANKS, PATTERN).count() == odd_docs.count()
    assert secrets.secrets_per_document(odd_docs.limit(0), RANKS, PATTERN).count() == 0


def test_keys_in_one_case_and_around_patterns(make_docs):
    hexes, part = "0123456789abcdef01234567", "qZ7xK9wPv3Lm"
    keys = ["qzxkvjwpqmznxbvclaksjdhfgtyr", "QZXKVJWPQMZNXBVCLAKSJDHFGTYR", 2 * part + hexes + 2 * part, part + hexes + part]
    words = ["internationalization-and-localization", "anticonstitutionnellement", "MAX_CHARS_PER_TOKEN_LIMIT", "einpfschschheitpfkeit", "my_very_own_service_token=abcdefgh", "A1" * 20]
    got = {r.doc_id: r for r in secrets.secrets_per_document(make_docs(list(enumerate([f"a {k} b" for k in keys + words]))), RANKS, PATTERN).collect()}
    whole = lambda k: f"dense:2:{2 + len(k)}"
    around = lambda n: f"dense:2:{2 + n},hex:{2 + n}:{26 + n},dense:{26 + n}:{26 + 2 * n}"
    assert [got[k].spans for k in range(4)] == [whole(keys[0]), whole(keys[1]), around(24), around(12)]
    assert [got[4 + k].n_dense for k in range(len(words))] == [0] * len(words)


def test_many_stated_spans_in_one_text_are_passed_once():
    import time

    text = "\n".join(hashlib.sha1(str(k).encode()).hexdigest() for k in range(100_000))
    start = time.time()
    spans = secrets.text_spans(text, lambda run: 2.0)
    assert len(spans) == 100_000 and time.time() - start < 5


def test_dense_spans_equal_plain_ratios():
    import random

    rng, ratio = random.Random(3), secrets._ratio(RANKS, PATTERN)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
    runs = ["".join(rng.choices(letters, k=rng.randint(15, 60))) for _ in range(300)] + ["internationalization", "a" * 25, "token_of_appreciation_and", "2024-01-01-2024-01-01-00"]
    for run in runs:
        got = [(a, b) for a, k, b, _ in secrets.text_spans(f"é {run} .", ratio) if k == len(secrets.KINDS)]
        # Runs without a stated pattern inside are judged whole.
        if any(secrets._base_spans(run)) or len(run) < 20:
            continue
        plain = len(run) / len(ratio.encoding.encode_ordinary(run))
        limit = 1.9 if secrets.in_one_case(run) else 2.2
        assert got == ([(2, 2 + len(run))] if plain < limit and not secrets.harmless(run) else []), run
