"""Conversation repair against an exhaustive search over an automaton, which shares no code with the operator."""

import hashlib
import random
from functools import lru_cache

import pytest

from gleanery.llm import turns

NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def search(letters, faults):
    """Least (cost, audit) over all edits; states: nothing yet, after s, after u, after a."""

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "")] if i == len(letters) and state in (0, 3) else []
        steps = NEXT[state]
        if inserts < 6:
            found += [(c + 2, "I" + a) for x in "ua" if x in steps for c, a in [best(i, steps[x], inserts + 1)]]
        if i < len(letters):
            c, a = best(i + 1, state, 0)
            found.append((c + 3, "D" + a))
            if faults[i] not in (1, 2):
                cut = faults[i] == 3
                if letters[i] in steps:
                    c, a = best(i + 1, steps[letters[i]], 0)
                    found.append((c + cut, "K" + a))
                found += [(c + 2 + cut, "R" + a) for x in "ua" if x in steps for c, a in [best(i + 1, steps[x], 0)]]
        return min(found, default=(10**6, ""))

    return best(0, 0, 0)


@pytest.mark.parametrize("cells", [4_000_000, 1])
def test_align_equals_search(monkeypatch, cells):
    """With whole tables, and with tables of which only some rows are held."""
    monkeypatch.setattr(turns, "CELLS", cells)
    rnd = random.Random(3)
    for _ in range(1500):
        n = rnd.randint(0, 11)
        letters = "".join(rnd.choice("uuuaaas x") for _ in range(n))
        faults = bytes(rnd.choice([0, 0, 0, 0, 1, 2, 3, 3]) for _ in range(n))
        assert turns.align(letters, faults) == search(letters, faults), (letters, list(faults))


def test_long_conversations_in_both_ways(monkeypatch):
    rnd = random.Random(5)
    letters = "".join(rnd.choice("ua") if rnd.random() < 0.2 else "ua"[i % 2] for i in range(700))
    faults = bytes(rnd.choice([0] * 17 + [1, 2, 3]) for _ in range(700))
    whole = turns.align(letters, faults)
    monkeypatch.setattr(turns, "CELLS", 1000)
    assert turns.align(letters, faults) == whole


def test_repair(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "user", "Hi again."), (1, 3, "assistant", "cut"),
        (2, 5, "system", "Be."), (2, 6, "user", " \n"), (2, 7, "user", "Q?"), (2, 8, "assistant", "A!"), (2, 8, "assistant", "A!"),
        (3, None, None, None), (None, None, "user", "x."), (None, 2, "assistant", "y."), (4, 1, "", "z."), (5, 1, "user", "\u00a0"),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, audit string").repartition(3)
    found, repaired = turns.repair(df)
    got = {r["conv_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == {
        1: (1, 0, 0, 1, 1, 3, "KIKK"), 2: (0, 1, 1, 0, 2, 6, "KDKKD"), 3: (0, 1, 0, 0, 0, 3, "D"), None: (0, 0, 0, 0, 0, 0, "KK"),
        4: (0, 0, 0, 0, 0, 3, "D"), 5: (0, 0, 0, 1, 0, 3, "D"),
    }
    lines = {}
    for r in repaired.collect():
        lines.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    assert [t for _, t in sorted(lines[1])] == ["user:Hi.", "assistant:", "user:Hi again.", "assistant:cut"]
    assert [t for _, t in sorted(lines[2])] == ["system:Be.", "user:Q?", "assistant:A!"] and 3 not in lines
    want = {k: hashlib.sha256("\n".join(t for _, t in sorted(v)).encode()).hexdigest() for k, v in lines.items()}
    assert {r["conv_id"]: r["repaired_sha256"] for r in turns.digests(repaired).collect()} == want
    assert turns.repair(df.limit(0))[1].count() == 0
