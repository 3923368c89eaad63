"""Chat windows: exact round trip, whole turns, targets once."""

import hashlib
import random
from collections import defaultdict

import pytest

from reelsift.llm import chat

TURNS = "conv_id long, turn long, role string, text string, window long, piece string"


@pytest.fixture(scope="module")
def turns(spark, prose):
    rng = random.Random(6)
    rows = []
    for c in range(20):
        for t in range(rng.randint(1, 60)):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, prose(rng.randint(0, 40), c * 100 + t) if rng.random() > 0.1 else None, 1, "p"))
    odd = ["<|im_end|>", "<|im_start|>assistant\nno", "<\\|im_end|>", "<\\\\|", "\\<|", "<", "", "a\n\nb ", "\U0001f600 é"]
    rows += [(50, t, ("user", "assistant")[t % 2], x, 1, "p") for t, x in enumerate(odd * 2)]
    rows += [(51, 0, None, None, 1, "p"), (51, None, "a\nb\\c<|", "null turn", 1, "p"), (None, 0, "assistant", "no id", 1, "p"), (52, 0, "assistant", "long " * 20_000, 1, "p")]
    rows += [(53, 1, "assistant", "same", 1, "p")] * 3
    return rows


def expected(rows):
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = {}
    for c, own in by.items():
        own.sort()
        loss = "".join(x for _, r, x in own if r == "assistant")
        out[c] = (len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss))
    return out


@pytest.mark.parametrize(("span", "history"), [(1024, 256), (40, 20), (1, 0)])
def test_round_trip(spark, turns, span, history):
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    windows = chat.format_conversations(df, span, history)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.conversation_digests(windows).collect()}
    assert got == expected(turns)


def test_windows(spark, turns):
    df = spark.createDataFrame(turns, TURNS)
    rows = chat.format_conversations(df, 100, 40).orderBy("conv_id", "window").collect()
    assert max(r.n_repeated for r in rows) > 2
    sizes = {c: max(len(x or "") for k, _, _, x, *_ in turns if k == c) for c in {t[0] for t in turns}}
    for r in rows:
        assert r.text.startswith(chat.START) and r.text.endswith(chat.END + "\n") and r.text.count(chat.START) == r.n_turns
        if r.conv_id is not None and r.conv_id % 3 == 0 and r.conv_id < 20:
            assert r.text.startswith(chat.START + "system\n")
        for s in r.loss:
            assert r.text[: s.start].endswith(chat.START + "assistant\n") and r.text[s.end :].startswith(chat.END)
        if sizes[r.conv_id] < 400:
            assert r.n_tokens < 2 * 100 + 40 + 400


def test_blocks_do_not_change_windows(spark, turns, monkeypatch):
    df = spark.createDataFrame(turns, TURNS)
    told = lambda: sorted(map(repr, chat.format_conversations(df, 60, 20).collect()))
    whole = told()
    monkeypatch.setattr(chat, "BLOCK_TURNS", 3)
    assert told() == whole


def test_empty_table_and_plan(spark, turns):
    df = spark.createDataFrame(turns, TURNS)
    windows = chat.format_conversations(df)
    plan = chat.conversation_digests(windows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.format_conversations(df, 10, 20)
