"""Conversation repair: every column against a plain table of strings, and the distributed parts with tiny blocks."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from reelsift.llm import conversation_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string, block long, nth int, first boolean, edits string, kind int, conversation long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, True, "x", 3, 4) for r in rows], SCHEMA).repartition(3)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        told = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(":".join(told).encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return out


def cheapest(rows):
    """Viterbi that carries whole strings: the cheapest (cost, audit) to each role so far, any number of insertions."""
    best = {"": (0, "", [])}
    follows = {"": {"s", "u"}, "s": {"u"}, "u": {"a"}, "a": {"u"}}
    full = {"u": "user", "a": "assistant"}

    def insert(ways):
        for _ in range(4):
            more = dict(ways)
            for last, (cost, audit, lines) in ways.items():
                for new in follows[last] - {"s"}:
                    way = (cost + 2, audit + "I", [*lines, full[new] + ":"])
                    if new not in more or way[:2] < more[new][:2]:
                        more[new] = way
            ways = more
        return ways

    for role, text, fault in rows:
        after = {}
        for last, (cost, audit, lines) in insert_all(best, follows, full):
            late = int(fault == "truncated")
            options = [(last, cost + 3, audit + "D", lines)]
            if fault not in ("blank", "duplicate"):
                if role[:1] in follows[last]:
                    options.append((role[:1], cost + late, audit + "K", [*lines, f"{role}:{text}"]))
                options += [(new, cost + 2 + late, audit + "R", [*lines, f"{full[new]}:{text}"]) for new in follows[last] - {"s"}]
            for new, *way in options:
                if new not in after or tuple(way[:2]) < after[new][:2]:
                    after[new] = tuple(way)
        best = after
    return min(insert(best)[k] for k in ("", "a") if k in insert(best))


def insert_all(best, follows, full):
    """Every state with every number of insertions up to four after it."""
    for last, way in best.items():
        state, (cost, audit, lines) = last, way
        yield state, (cost, audit, lines)
        for _ in range(4):
            state = next(iter(follows[state] - {"s"}))
            cost, audit, lines = cost + 2, audit + "I", [*lines, full[state] + ":"]
            yield state, (cost, audit, lines)


def plain_report(rows, everyone):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    out = {}
    for conv in everyone:
        own = sorted(groups[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, marked, count = set(), [], defaultdict(int)
        for _, role, text in own:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked[:-1], marked[1:], strict=True))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(marked)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


ROLES = ["user", "assistant", "system", "tool", "", None, "Assistant"]
TEXTS = ["Yes.", "No!", "open", "", " \t\n", None, "a?  \n", "end ", "\x85", "x.　", "(.)"]


def conversations(n, seed=1, longest=9):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(ROLES) if rng.random() < 0.4 else ["user", "assistant"][turn % 2]
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"line {rng.randint(0, 30)}" + rng.choice([".", "!", ""])
            out.append((conv if conv else None, rng.choice([turn, turn, turn, 7, None]), role, text))
    return out


def check(spark, rows, damaged=True):
    turns = frame(spark, rows)
    found = repair.repair_report(repair.damaged(turns) if damaged else turns, turns)
    got = {r.conv_id: tuple(r)[1:] for r in found.collect()}
    kept = plain_damage(rows) if damaged else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got == plain_report(kept, {r[0] for r in rows})


def test_report_equals_plain_version(spark):
    check(spark, conversations(300) + [(900, 0, "user", "gone."), (901, None, None, None)])


@pytest.mark.parametrize(("block", "fan"), [(2, 2), (3, 4), (1, 3)])
def test_blocks_and_trees_change_nothing(spark, monkeypatch, block, fan):
    monkeypatch.setattr(repair, "BLOCK", block)
    monkeypatch.setattr(repair, "FAN", fan)
    check(spark, conversations(20, seed=block, longest=40), damaged=False)


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 16)
    rng = random.Random(4)
    hot = [(5, k // 2, rng.choice(["user", "assistant"]), rng.choice(["Same.", f"own {k}.", ""])) for k in range(900)]
    check(spark, conversations(20) + hot + [(6, None, "user", "Same.")] * 100)


def test_sequences_of_all_kinds():
    rng = random.Random(9)
    faults, roles = ["", "blank", "duplicate", "truncated"], ["system", "user", "assistant", "tool"]
    for n in range(1, 300):
        kinds = bytes(rng.randrange(16) for _ in range(n % 23))
        edits = repair.solve(kinds)
        want = cheapest([(roles[k // 4], "t", faults[k % 4]) for k in kinds])
        assert (repair.cost_of(kinds, edits), "".join(edits)) == want[:2]


def test_long_sequences_are_solved_in_linear_space():
    kinds = bytes(random.Random(2).choice([4, 8, 8, 4, 7, 5, 0, 12]) for _ in range(20_000))
    edits = repair.solve(kinds)
    assert len(edits) == len(kinds) + 1
    vector = ((0, 0), (1 << 60, 4), (1 << 60, 4), (1 << 60, 4))
    for kind in kinds:
        vector = repair.forward(vector, repair.row_matrix(kind))
    assert repair.cost_of(kinds, edits) == min(c + more for (c, _), (more, _) in zip(vector, repair.CLOSING, strict=True))


def test_repaired_turns_alternate(spark):
    turns = frame(spark, conversations(60, seed=8))
    told = defaultdict(list)
    for r in sorted(repair.Repair(turns).turns().collect(), key=lambda r: (r.block, r.place)):
        told[r.conv_id].append((r.role, r.text, r.edit))
    assert any(e == "I" for own in told.values() for _, _, e in own)
    for own in told.values():
        assert re.fullmatch("s?(ua)+", "".join(role[0] for role, _, _ in own))
        assert all(text == "" for _, text, e in own if e == "I")


def test_empty_table(spark):
    empty = frame(spark, conversations(1)).limit(0)
    assert repair.repair_report(repair.damaged(empty), empty).count() == 0
    assert repair.Repair(empty).turns().count() == 0


def test_all_rows_dropped(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    check(spark, [(3, turn, "user", "Hello.")])
