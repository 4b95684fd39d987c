"""Exact dedup, near-dedup and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from text_fixtures import docs, plan  # noqa: F401

from tidemark.llm.common import ascii_words, word_hashes
from tidemark.llm.exact_dedup import DigestIndex, exact_dedup
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.native import maybe_among, with_mark
from tidemark.llm.minhash import FastSimilaritySketch, bands_for, near_duplicates, parity_bitmaps, shingle_sets
from tidemark.session import shared_dir

CLASHING = ("kept", "keep_id", "group_size", "text_sha256", "id", "key", "node", "n", "label", "hash", "lines",
            "tie", "chunks", "component_id", "_text", "_gone", "_n", "n_lines", "n_removed", "chunk")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- exact dedup -------------------------------------------------------------------


def test_largest_id_of_equal_texts_stays(docs):
    rows = [(1, "a"), (2, "a"), (3, "b"), (4, None), (5, ""), (6, "A"), (7, "a ")]
    found = {r.doc_id: r for r in exact_dedup(docs(rows, CLASHING)).collect()}
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in found.items()} == {
        1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (5, 2, False), 5: (5, 2, True),
        6: (6, 1, True), 7: (7, 1, True),
    }
    assert found[4].text_sha256 == sha("") and found[1].text_sha256 == sha("a")


def test_repeated_rows_null_ids_and_long_texts(docs):
    long = "word " * 200_000
    rows = [(1, "x"), (1, "x"), (None, "x"), (None, "only"), (None, "only"), (2, long), (3, long + "!")]
    found = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(rows)).collect()]
    assert sorted(found, key=str) == sorted([
        (1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False),
        (None, None, 2, True), (None, None, 2, True), (2, 2, 1, True), (3, 3, 1, True),
    ], key=str)
    assert exact_dedup(docs([])).collect() == []


def test_index_outlives_batches_and_takes_a_batch_twice(spark, docs):
    path = shared_dir(spark, "index-test")
    index = DigestIndex(spark, path, buckets=3)
    exact_dedup(docs([(1, "a"), (2, "b")]), index)
    again = DigestIndex(spark, path, buckets=3)
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup(docs([(7, "b"), (8, "c"), (9, "c")]), again).collect()}
    assert found == {7: (2, False), 8: (9, False), 9: (9, True)}
    exact_dedup(docs([(7, "b"), (8, "c"), (9, "c")]), again)
    assert sorted((r.text_sha256, r.keep_id) for r in again.table().collect()) == sorted(
        [(sha("a"), 1), (sha("b"), 2), (sha("c"), 9)]
    )


def test_an_index_is_opened_with_the_buckets_it_was_made_with(spark, docs):
    path = shared_dir(spark, "index-reopened")
    batch = [(i, f"text {i}") for i in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        first = DigestIndex(spark, path)
        exact_dedup(docs(batch), first)
        first.close()
        spark.conf.set("spark.sql.shuffle.partitions", "5")
        again = DigestIndex(spark, path)
        assert again.buckets == 3
        found = exact_dedup(docs([(i + 1000, t) for i, t in batch]), again).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert not any(r.kept for r in found) and again.table().count() == 200
    with pytest.raises(ValueError, match="3 buckets"):
        DigestIndex(spark, path, buckets=5)


def test_long_paths_stay_apart_and_no_table_is_left(spark, docs):
    root = shared_dir(spark, "x" * 40)
    paths = [f"{root}/{name}/{'y' * 100}" for name in "ab"]
    indexes = [DigestIndex(spark, p, buckets=2) for p in paths]
    exact_dedup(docs([(1, "one")]), indexes[0])
    assert [i.table().count() for i in indexes] == [1, 0]
    for index in indexes:
        index.close()
    tables = {t.name for t in spark.catalog.listTables()}
    found = exact_dedup(docs([(1, "one"), (2, "one")]))
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert sorted(r.kept for r in found.collect()) == [False, True]


def test_anti_join_reads_the_index_in_its_buckets(spark, docs):
    index = DigestIndex(spark, shared_dir(spark, "index-plan"), buckets=8)
    exact_dedup(docs([(i, str(i)) for i in range(50)]), index)
    new = spark.range(10).selectExpr("sha2(cast(id as string), 256) AS text_sha256").distinct()
    text = plan(new.join(index.table().hint("merge"), "text_sha256", "left_anti"))
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    assert text.count("Exchange") <= 2  # of the new rows only


# --- near dedup --------------------------------------------------------------------


def brute_sets(rows, k):
    out = {}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    return out


def brute_components(sets, percent):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    rows, n = [], 0
    for length in (3, 8, 30, 120, 400):
        for _ in range(4):
            base = [f"w{rng.randrange(500)}" for _ in range(length)]
            for e in (0, 0, 1, 2, 4, 9, 15):
                rows.append((n, edited(base, rng, e) if e else " ".join(base).upper()))
                n += 1
    # A chain: each like the next, the ends unlike each other.
    chain = [f"c{j}" for j in range(100)]
    for j in range(12):
        rows.append((n, " ".join(chain)))
        n += 1
        chain = [*chain[6:], *(f"d{j}x{i}" for i in range(6))]
    return [*rows, (n, ""), (n + 1, None), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "é É")]


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_copies_match_brute_force(docs, copies, words, percent):
    want = brute_components(brute_sets(copies, words), percent)
    rows = list(copies)
    random.Random(1).shuffle(rows)
    found = near_duplicates(docs(rows, CLASHING), words, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == want
    assert len(found) == len(copies)


def test_large_bucket_of_unlike_members_loses_no_link(docs, monkeypatch):
    """Buckets that hold several components, with pivots a few at a time."""
    import tidemark.llm.minhash as minhash

    monkeypatch.setattr(minhash, "SMALL_BUCKET", 4)
    monkeypatch.setattr(minhash, "PIVOTS", 2)
    monkeypatch.setattr(minhash, "BAND_ROWS", 1)
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(40)]
    rows = []
    for group in range(6):
        own = [f"g{group}x{i}" for i in range(25)]
        for _ in range(5):
            rows.append((len(rows), edited(shared + own, rng, 2)))
    want = brute_components(brute_sets(rows, 3), 80)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs(rows), 3, 80).collect()}
    assert found == want
    assert len({c for _, c, _ in want.values()}) > 3


def test_near_dedup_null_ids_repeated_rows_and_empty_tables(docs):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (5, text), (5, text), (3, text + " x"), (9, "w" * 300_000)]
    found = sorted(((str(r.doc_id), r.component_id, r.kept) for r in near_duplicates(docs(rows), 3, 85).collect()), key=str)
    assert found == sorted(
        [("None", None, True), ("5", 3, False), ("5", 3, False), ("3", 3, True), ("9", 9, True)], key=str
    )
    assert near_duplicates(docs([]), 3, 85).collect() == []


def test_sketch_is_full_and_unbiased():
    rng = np.random.default_rng(3)
    sketch = FastSimilaritySketch(128)
    assert (sketch.of(np.array([7], np.uint64)) != np.iinfo(np.uint64).max).all()
    for n, shared in ((1, 1), (12, 9), (300, 200), (5_000, 4_500)):
        equal = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 2 * n - shared).astype(np.uint64)
            equal.append((sketch.of(x[:n]) == sketch.of(x[n - shared :])).mean())
        assert abs(np.mean(equal) - shared / (2 * n - shared)) < 0.03
    rows = bands_for(85)
    assert (1 - 0.85**6) ** rows <= 1e-5 < (1 - 0.85**6) ** (rows - 1)


def test_bitmaps_differ_in_no_more_bits_than_sets_in_elements():
    rng = np.random.default_rng(8)
    for n, lost in ((0, 0), (1, 1), (60, 5), (3_000, 40), (3_000, 2_000)):
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.concatenate([x[lost:], rng.integers(0, 2**63, lost).astype(np.uint64)])
        maps = parity_bitmaps(np.concatenate([x, y]), np.array([len(x), len(y)])).to_pylist()
        bits = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(*maps, strict=True))
        assert bits <= 2 * lost and (bits > 0 or lost < 2)
    assert len(parity_bitmaps(np.zeros(0, np.uint64), np.zeros(0, np.int64))) == 0


def test_word_hashes_depend_on_the_word_alone():
    words = ["", "a", "aa", "a" * 8, "a" * 9, "b" * 16, "é" * 4, "x" * 256, "x" * 257, "a\x00", "a\x00\x00"]
    texts = pa.array([" ".join(w for w in words if w), None, " \t\n"])
    flat, counts = ascii_words(texts)
    assert flat.to_pylist() == words[1:] and counts.tolist() == [len(words) - 1, 0, 0]
    one_by_one = [int(word_hashes(pa.array([w]))[0]) for w in words[1:]]
    assert word_hashes(flat).tolist() == one_by_one
    assert word_hashes(flat[3:]).tolist() == one_by_one[3:]
    assert len(set(one_by_one)) == len(one_by_one)
    assert [int(n) for n in shingle_sets(texts, 3)[1]] == [len(words) - 3, 0, 0]


# --- line dedup --------------------------------------------------------------------


def brute_lines(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines, gone = (text or "").split("\n"), set()
        filled = [k for k, line in enumerate(lines) if line.strip(" \t\r")]
        for a, b in zip(filled, filled[1:]):
            if (lines[a], lines[b]) in seen:
                gone |= set(range(a, b + 1))
            seen.add((lines[a], lines[b]))
        out[i] = ("\n".join(line for k, line in enumerate(lines) if k not in gone), len(lines), len(gone))
    return out


def test_repeated_chunks_go_and_match_brute_force(docs):
    rng = random.Random(2)
    passage = [f"passage line {i}" for i in range(12)]
    rows = []
    for i in range(30):
        own = [f"line {rng.randrange(10**6)}" for _ in range(rng.randrange(1, 12))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + passage * (i % 3) + own[at:])))
    rows += [(30, ""), (31, None), (32, "\n\n\n\n"), (33, "\n\n\n\n"), (34, "a\na\na\na"), (35, "a\na\na\na")]
    want = brute_lines(rows)
    found = dedup_lines(docs(rows, tuple(c for c in CLASHING if c not in ("n_lines", "n_removed")))).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in found} == want
    assert found[0].lang == "en" and found[0].key == "x" and found[0]._n == "x"
    assert "passage line" in want[1][0] and "passage line" not in want[4][0]


@pytest.mark.parametrize("length", range(2, 7))
def test_runs_of_few_lines_are_found_in_other_texts(docs, length):
    rng = random.Random(length)
    line = lambda: f"line {rng.randrange(10**9)}"
    rows = []
    for i in range(0, 80, 2):
        passage = [line() for _ in range(length)]
        spaced = [x for p in passage for x in (p, " ")][:-1]
        rows.append((i, "\n".join([line() for _ in range(rng.randrange(5))] + passage + [line()])))
        rows.append((i + 1, "\n".join([line(), ""] + spaced + [line() for _ in range(rng.randrange(5))])))
    found = {r.doc_id: r for r in dedup_lines(docs(rows)).collect()}
    assert {i: (r.text, r.n_lines, r.n_removed) for i, r in found.items()} == brute_lines(rows)
    assert all(found[i].n_removed == (0 if i % 2 == 0 else 2 * length - 1) for i in found)


def test_one_repeated_line_stays(docs):
    rows = [(1, "a\nsame\nb"), (2, "c\nsame\nd"), (3, "\n\n same\n"), (4, "")]
    assert all(r.n_removed == 0 for r in dedup_lines(docs(rows)).collect())


def test_line_dedup_null_ids_repeated_rows_and_empty_tables(docs):
    text = "\n".join(f"line {i}" for i in range(20))
    found = dedup_lines(docs([(4, text), (4, text), (None, text), (2, "x " * 100_000)])).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in found) == [("2", 0), ("4", 20), ("4", 20), ("None", 0)]
    assert dedup_lines(docs([])).collect() == []


def test_line_dedup_is_native(docs):
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan(dedup_lines(docs([(1, "a\nb"), (2, "a\nb")])))]


def test_marks_lose_no_wanted_key(spark):
    df = spark.range(3000).selectExpr("if(id % 10 = 0, null, id) AS k", "id AS v")
    wanted = spark.range(0, 3000, 7).selectExpr("id AS w")
    kept = {r.k for r in maybe_among(df, "k", wanted).collect()}
    want = {i for i in range(0, 3000, 7) if i % 10}
    assert want <= kept and len(kept - want) < 5 and None not in kept
    marked = with_mark(df, "k", wanted, "m")
    assert marked.count() == 3000 and marked.columns == ["k", "v", "m"] and marked.filter("m is null").isEmpty()
    assert maybe_among(df, "k", wanted.limit(0)).isEmpty()
