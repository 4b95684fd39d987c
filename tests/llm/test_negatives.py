"""Hard negatives against scoring everything."""

from __future__ import annotations

import math

import numpy as np
import pytest

import tidemark.llm.negatives as module
from pyspark.sql import functions as F
from tidemark.llm.negatives import Queries, codes, exact, hard_negatives, rotation

ROWS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=10, positives=5, negatives=3):
    kept = []
    for i, (key, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((i, key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    first = lambda scored, n: sorted(scored, key=lambda s: (-s[0], s[1] is None, s[1] or 0, s[2]))[:n]
    for i, key, v, label in kept:
        if key is None or key % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), k, j, l) for j, k, w, l in kept if j != i and len(w) == len(v)]
        for ps, pk, _, _ in first([s for s in scored if s[3] == label], positives):
            band = [s for s in scored if s[3] != label and 50 * ps <= 100 * s[0] <= 95 * ps]
            for rank, (ns, nk, _, _) in enumerate(first(band, negatives), 1):
                out.append((key, pk, rank, nk, ps, ns))
    return sorted(out, key=repr)


def check(spark, rows, extra=()):
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", *[f"'x' AS `{c}`" for c in extra])
    found = hard_negatives(df, F.col("id") % 10 == 0).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)
    return found


def clustered(rng, n, dim=16, labels=4, spread=0.6):
    centres = rng.standard_normal((labels, dim))
    marks = rng.integers(labels, size=n)
    vectors = centres[marks] * rng.random((n, 1)) + spread * rng.standard_normal((n, dim))
    return [(i, [float(np.float32(x)) for x in v], int(m)) for i, (v, m) in enumerate(zip(vectors, marks))]


@pytest.mark.parametrize("dim", [5, 64, 70])
def test_bounds_hold_for_every_pair(dim):
    rng = np.random.default_rng(dim)
    ints = np.floor(256 * rng.standard_normal((200, dim)))
    ints[3] = 0
    assert np.allclose(rotation(dim) @ rotation(dim).T, np.eye(dim))
    low, high = Queries(ints[:40]).bounds(slice(0, 40), *codes(ints))
    scores = ints[:40] @ ints.T
    assert (low <= scores).all() and (scores <= high).all()
    # The interval of a score is narrower than what lengths alone allow.
    lengths = np.linalg.norm(ints, axis=1)
    assert np.mean(high - low) < 0.8 * np.mean(2 * lengths[:40, None] * lengths[None])


def test_scores_are_whole_numbers_beyond_doubles():
    big = np.array([[2**28 - 1, -(2**28)]])
    assert exact(big, big[0])[0] == (2**28 - 1) ** 2 + 2**56


def test_all_rows_match_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_ROWS", 40)
    monkeypatch.setattr(module, "BLOCK_ANCHORS", 7)
    rng = np.random.default_rng(5)
    found = check(spark, clustered(rng, 400), ("id", "rank", "group", "dim", "uid", "bits", "anchors", "positive_id"))
    assert len(found) > 300


def test_ties_common_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(6)
    rows = clustered(rng, 60)
    common = rows[0][1]
    rows = [(i, common if i % 3 == 0 else v, m) for i, v, m in rows] + [rows[4], rows[4]]
    check(spark, rows)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(7)
    rows = clustered(rng, 50, dim=4)
    nan, inf = float("nan"), float("inf")
    rows += [
        (60, [nan, 1.0, 1.0, 1.0], 1), (70, [1.0, inf, 1.0, 1.0], 1), (80, [1.0, None, 1.0, 1.0], 1), (90, None, 1),
        (100, [1.0] * 4, None), (None, [1.0] * 4, 2), (None, [0.5] * 4, 1), (110, [], 1), (120, [1.0, 2.0], 1),
        (121, [1.0, 1.5], 1), (122, [0.5, 0.75], 2), (130, [-1.0] * 4, 3), (140, [0.0] * 4, 3),
    ]
    check(spark, rows)
    huge = [*rows, (150, [3e38] * 4, 1)]
    df = spark.createDataFrame(huge, ROWS)
    found = hard_negatives(df, F.col("id") % 10 == 0).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)
    assert hard_negatives(spark.createDataFrame([], ROWS), F.col("id") % 10 == 0).collect() == []
