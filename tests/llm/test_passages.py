"""Repeated passages against brute force."""

from __future__ import annotations

import random
import re

import pytest
from text_fixtures import docs  # noqa: F401

from tidemark.llm.passages import COVER, PERIOD, WINDOW, Words, anchors_of, dedup_passages, rolled

CLASHING = ("id", "key", "tie", "base", "places", "gone", "copy", "start", "n", "n_words", "n_removed", "anchor", "w1")


def brute(rows, window=WINDOW):
    """Words kept of each (id, text), in order; equal rows are one text."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, out = set(), {}
    for row in order:
        words = re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")
        gone = set()
        for i in range(len(words) - window + 1):
            body = tuple(words[i : i + window])
            if body in seen:
                gone |= set(range(i, i + window))
            seen.add(body)
        out[row] = (" ".join(w for i, w in enumerate(words) if i not in gone), len(words), len(gone))
    return out


def check(docs, rows, extra=()):
    found = dedup_passages(docs(rows, extra)).collect()
    wanted = brute(rows)
    mine = sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in found), key=repr)
    assert mine == sorted(((i, *wanted[i, t]) for i, t in rows), key=repr)


def test_every_difference_is_one_of_the_cover():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_rolled_hashes_hang_on_the_words_alone():
    import pyarrow as pa

    words = Words(pa.array(["x y " + " ".join(map(str, range(40))), " ".join(map(str, range(5, 40)))]))
    for length in (1, 2, 5, 8, 20):
        h = rolled(words.hashed, length, 4)
        first = {tuple(words.flat[i : i + length].to_pylist()): h[i] for i in words.runs(length)}
        assert len(set(first.values())) == len(first)
        assert all(first[tuple(words.flat[i : i + length].to_pylist())] == h[i] for i in words.runs(length))
    assert len(rolled(words.hashed[:3], 8, 1)) == 0
    at, hashes = anchors_of(words, WINDOW)
    assert len(at) == len(hashes) and set(words.place[at] % PERIOD) <= set(COVER)


def test_planted_passages_of_every_length_and_offset(docs):
    rng = random.Random(3)
    fresh = lambda n: [f"{rng.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(60):
        passage = fresh(18 + i % 17)
        rows.append((2 * i, " ".join(fresh(i % 14) + passage + fresh(rng.randrange(30)))))
        rows.append((2 * i + 1, " ".join(fresh(rng.randrange(40)) + passage + fresh(5))))
    check(docs, rows, CLASHING)


def test_junctions_overlaps_and_repeats_within_a_text(docs):
    rng = random.Random(4)
    p, q, r = ([f"{c}{rng.randrange(10**6)}" for _ in range(30)] for c in "pqr")
    rows = [
        (1, " ".join(p)), (2, " ".join(q)), (3, " ".join(p + q)), (4, " ".join(p[15:] + q[:15])),
        (5, " ".join(r + r + r)), (6, " ".join(r[5:] + p[:25])), (7, "ha " * 100), (8, "ha " * 19), (9, "ha " * 21),
    ]
    check(docs, rows)


def test_few_words_make_many_repeats(docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(120)))) for i in range(40)]
    check(docs, rows)


def test_copies_nulls_empty_long_and_repeated_rows(docs):
    rng = random.Random(6)
    body = " ".join(str(rng.randrange(10**6)) for _ in range(50))
    long = " ".join(str(i) for i in range(60_000))
    rows = [
        (None, body), (1, body), (1, body), (2, body.replace(" ", "\n\t")), (3, None), (4, ""), (5, " \n"),
        (6, long), (7, "x " + long + " " + long), (8, body + " tail"), (9, "a b"), (9, "a b"), (10, "é ü " * 15),
    ]
    check(docs, rows)
    assert dedup_passages(docs([])).collect() == []
    with pytest.raises(ValueError):
        dedup_passages(docs([]), window=5)


def test_rows_that_share_an_id_only(docs):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    found = {r.text for r in dedup_passages(docs([(1, a + " " + b), (1, b + " " + a)])).collect()}
    # One of the two comes first and stays whole; the junction of the other is its own.
    assert len(found) == 2 and (a + " " + b in found or b + " " + a in found)
    assert min(len(t.split()) for t in found) == 0
