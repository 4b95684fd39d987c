"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tidemark.llm.conversations import INSERTIONS, best_parse, damaged, joined, repair_conversations, span_cell, through, turn_cell

ROWS = "conv_id long, turn long, role string, text string"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        role, text = space(role), space(text)
        f = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(conv, turn, "user" if f == 4 else role, text)] * {0: 0, 3: 2}.get(f, 1)
    return out


def brute_faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        body = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def brute_repair(turns, faults):
    """Left to right over whole states: role before, rows done, at most two insertions in a row."""

    @lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(turns) and state in "-a":
            options.append((0, "", ()))
        steps = {"-": "su", "s": "u", "u": "a", "a": "u"}[state]
        for turn in steps:
            if turn != "s" and inserted < 2:
                cost, audit, lines = best(i, turn, inserted + 1)
                options.append((cost + 5, "I" + audit, (f"{dict(u='user', a='assistant')[turn]}:", *lines)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 2, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                for turn in steps:
                    cost, audit, lines = best(i + 1, turn, 0)
                    if role[:1] == turn:
                        options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                    elif turn != "s":
                        options.append((cost + more + 1, "R" + audit, (f"{dict(u='user', a='assistant')[turn]}:{text}", *lines)))
        return min(options) if options else (10**9, "", ())

    return best(0, "-", 0)


def brute(rows):
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    by = {}
    for conv, *turn in brute_damage(rows):
        by.setdefault(conv, []).append(tuple(turn))
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        faults = brute_faults(turns)
        cost, audit, lines = brute_repair(tuple(turns), tuple(faults))
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", *[f"'x' AS `{c}`" for c in extra])
    found = repair_conversations(damaged(df)).collect()
    wanted = brute(rows)
    assert len(found) == len(wanted)
    for r in found:
        assert tuple(r)[1:] == wanted[r.conv_id], r.conv_id


def made(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "", None, "Anna"]
    texts = ["yes.", "no?", "cut off", "", " \n", None, "hm!", "a. b"]
    turns = []
    for i in range(n):
        role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[i % 2]
        text = rng.choice(texts) if rng.random() < 0.5 else f"line {i}."
        turns.append((conv, None if rng.random() < 0.05 and i == 0 else i + (i > 3), role, text))
    return turns


def test_random_conversations_match_the_search(spark):
    rng = random.Random(8)
    rows = [t for conv in range(150) for t in made(rng, conv, rng.randrange(1, 11))]
    rows += made(rng, None, 6)
    rng.shuffle(rows)
    check(spark, rows, ("conv", "pos", "kinds", "dropped_", "cost", "audit", "first", "edits"))


def test_long_conversations_are_cut_into_spans(spark, monkeypatch):
    import tidemark.llm.conversations as module

    monkeypatch.setattr(module, "SPAN_TURNS", 3)
    rng = random.Random(9)
    check(spark, [t for conv in range(6) for t in made(rng, conv, 45)])


def test_empty_table_and_dropped_conversations(spark):
    assert repair_conversations(damaged(spark.createDataFrame([], ROWS))).collect() == []
    dropped = next(i for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "gone.")])


def test_repeated_rows_are_duplicates(spark):
    kept = next(i for i in range(200) if all(zlib.crc32(f"{i}:{t}".encode()) % 20 > 4 for t in (0, 1)))
    check(spark, [(kept, 0, "user", "a.")] * 4 + [(kept, 1, "assistant", "b.")] * 2)


@pytest.mark.parametrize("seed", range(5))
def test_every_cut_of_a_span_gives_the_same_cell(seed):
    rng = random.Random(seed)
    kinds = "".join(rng.choice("sua.") + rng.choice("--cx") for _ in range(37))
    whole = span_cell(kinds)
    for cut in range(2, len(kinds), 2):
        assert joined(span_cell(kinds[:cut]), span_cell(kinds[cut:])) == whole
    cells = [span_cell(kinds[i : i + 10]) for i in range(0, len(kinds), 10)]
    parts = [c[p] for c, p in zip(cells, through(cells))]
    assert (sum(c for c, _ in parts), "".join(a for _, a in parts)) == best_parse(whole)


def test_insertion_closure():
    assert INSERTIONS["-", "a"] == (10, "II") and INSERTIONS["u", "u"] == (0, "")
    assert best_parse(INSERTIONS) == (0, "")
    assert best_parse(turn_cell("u-")) == (2, "D")
    assert best_parse(span_cell("u-a-")) == (0, "KK")
