"""Encoding, packing and fingerprints: exact round trips and brute force."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from text_fixtures import docs, plan  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe, fingerprints
from tidemark.llm.packing import DotProductPacker, Limits, pack_texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
CLASHING = ("ids", "decoded", "start", "length", "offset", "sequence_id", "_text", "_prompt", "n", "key", "tie", "id",
            "edited", "anchors", "near_next", "part", "before", "n_chars_2")
EDGES = [(None, "null id"), (1, None), (2, ""), (3, " \n\t  x"), (4, "word " * 60_000), (5, "same"), (5, "same"),
         (6, "x" * 250_000), (7, "<|endoftext|> a"), (8, "日本語 é   b\x1c c")]

TEXT = st.text(alphabet=st.sampled_from("ab Z9'\n\t  \x1cé日.#s"), max_size=60)


@pytest.fixture(scope="module")
def own():
    return bpe.encoder(bpe.read_ranks(RANKS), PATTERN)


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=2000, deadline=None)
@given(TEXT)
def test_pieces_and_chunks_have_the_ids_of_the_text(text):
    own = bpe.encoder(bpe.read_ranks(RANKS), PATTERN)
    want = own.encode_ordinary(text)
    assert "".join(bpe.pieces(text, 5)) == text
    assert np.frombuffer(bpe.encode(text, own, 5), "<u4").tolist() == want
    assert np.frombuffer(bpe.ChunkIds(own).encode(text), "<u4").tolist() == want
    assert bpe.decode(bpe.encode(text, own), own) == text.encode()


def test_both_files_have_the_ids_of_the_tokenizers_library(reference, own):
    again = bpe.encoder(bpe.read_ranks(JSON), PATTERN, bpe.ranks_of_json)
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["the ", "Zürich", " 12", "\n", "'s", "日本", "  ", "###", "<|endoftext|>", "é"]) for _ in range(20))
        assert reference(text) == own.encode_ordinary(text) == again.encode_ordinary(text)


def test_chunk_memory_is_bounded(own, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    cache = bpe.ChunkIds(own)
    text = " ".join(f"w{i % 37}" for i in range(500)) + " " + "y" * 200
    assert np.frombuffer(cache.encode(text), "<u4").tolist() == own.encode_ordinary(text)
    assert len(cache) <= 20 and len(cache.old) <= 20


def test_round_trip_of_documents(docs, own):
    found = bpe.bpe_round_trip(docs(EDGES, CLASHING), RANKS, PATTERN).collect()
    assert len(found) == len(EDGES)
    by_id = {r.doc_id: r for r in found}
    for i, text in EDGES:
        assert bytes(by_id[i].decoded) == (text or "").encode()
        assert np.frombuffer(by_id[i].ids, "<u4").tolist() == own.encode_ordinary(text or "")
    assert bpe.bpe_round_trip(docs([]), RANKS, PATTERN).collect() == []


def test_decoding_ends_within_characters(own):
    ids = bpe.encode("日本", own)
    numbers = np.frombuffer(ids, "<u4").tolist()
    for n in range(len(numbers) + 1):
        part = bpe.decode(ids[: 4 * n], own)
        assert part == b"".join(own.decode_single_token_bytes(i) for i in numbers[:n])
    assert bpe.decode(ids, own) == "日本".encode()


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="given tables are not here")
def test_ids_of_given_documents_are_those_of_the_tokenizers_library(reference):
    again = bpe.encoder(bpe.read_ranks(JSON), PATTERN, bpe.ranks_of_json)
    chunks = bpe.ChunkIds(again)
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()
    for text in texts:
        assert np.frombuffer(chunks.encode(text or ""), "<u4").tolist() == reference(text or "")


# --- packing -----------------------------------------------------------------------


def padding(rows, most=1024):
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id] += r.length
    return sum(most - n for n in by.values() if n & (n - 1)), by


def check_pieces(rows, ids_of, most=1024):
    """Each id in one piece, sequences gapless and within the limit."""
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= most
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for i, ids in ids_of.items():
        at = 0
        data = np.array(ids, "<u4").tobytes()
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert zlib.crc32(data[4 * at : 4 * (at + r.length)]) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    assert set(by_doc) == set(ids_of)


def test_every_id_is_packed_once_with_little_padding(docs, reference):
    rng = random.Random(6)
    rows = [(i + 100, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice((1, 5, 50, 400, 3000))))) for i in range(150)]
    rows += [e for e in EDGES if e[0] != 5]
    found = pack_texts(docs(rows, CLASHING), JSON, PATTERN).collect()
    check_pieces(found, {i: [*reference(t or ""), 0] for i, t in rows})
    wasted, by = padding(found)
    assert wasted == 0 and all(n == 1024 or n & (n - 1) == 0 for n in by.values())


def test_packing_repeated_rows_and_empty_tables(docs):
    found = pack_texts(docs([(5, "same"), (5, "same"), (None, None)]), JSON, PATTERN).collect()
    assert sorted((str(r.doc_id), r.doc_tokens) for r in found if r.start == 0) == [("5", 2), ("5", 2), ("None", 1)]
    assert sum(r.length for r in found) == 5
    assert pack_texts(docs([]), JSON, PATTERN).collect() == []


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 90), st.integers(0, 90)), max_size=60),
    st.integers(1, 64), st.integers(1, 9), st.integers(1, 64), st.integers(1, 12),
)
def test_limits_hold_in_all_dimensions(examples, tokens, segments, loss, pool):
    limits = Limits(tokens, segments, loss)
    packer = DotProductPacker(limits, pool)
    out = []
    for key, (n, m) in enumerate(examples):
        out += packer.add(key, np.arange(n, dtype="<u4").tobytes(), m)
        assert len(packer.pieces) <= pool + 1
    out += packer.finish()
    used = defaultdict(lambda: np.zeros(3, int))
    spans = defaultdict(list)
    for key, start, length, _, total, sequence, _, bears in out:
        n, m = examples[key]
        first = n - min(n, m)
        assert total == n and bears == max(0, start + length - max(start, first))
        used[sequence] += (length, 1, bears)
        spans[key].append((start, length))
    assert all((u <= limits.vector()).all() for u in used.values())
    for key, (n, _) in enumerate(examples):
        at = 0
        for start, length in sorted(spans[key]):
            assert start == at
            at += length
        assert at == n


def test_dot_product_prefers_what_fills_the_room_left():
    packer = DotProductPacker(Limits(10, 4, 10), pool=3)
    ids = lambda n: np.zeros(n, "<u4").tobytes()
    out = [row for key, n in enumerate((3, 7, 2, 6)) for row in packer.add(key, ids(n))]
    assert [(key, length, offset) for key, _, length, _, _, _, offset, _ in out] == [(1, 7, 0), (0, 3, 7)]


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(1, "answer here", "the question"), (2, None, None)], "doc_id int, text string, p string")
    found = pack_texts(df, JSON, PATTERN, prompt_col="p").collect()
    total = {i: (sum(r.length for r in found if r.doc_id == i), sum(r.loss_tokens for r in found if r.doc_id == i)) for i in (1, 2)}
    own = bpe.encoder(bpe.read_ranks(RANKS), PATTERN)
    prompt, answer = (len(own.encode_ordinary(t)) for t in ("the question", "answer here"))
    assert total == {1: (prompt + answer + 1, answer + 1), 2: (1, 1)}


def test_each_of_three_limits_binds_in_one_stream():
    limits, rng = Limits(64, 6, 24), random.Random(3)
    packer, used = DotProductPacker(limits, 12), defaultdict(lambda: np.zeros(3, int))
    sizes = [rng.choice(((2, 0), (30, 2), (8, 8), (40, 30), (1, 1))) for _ in range(600)]
    out = []
    for key, (n, m) in enumerate(sizes):
        out += packer.add(key, np.arange(n, dtype="<u4").tobytes(), m)
    out += packer.finish()
    for key, start, length, _, total, sequence, _, bearing in out:
        first_loss = total - min(total, sizes[key][1])
        assert bearing == max(0, start + length - max(start, first_loss))
        used[sequence] += (length, 1, bearing)
    sums = np.array(list(used.values()))
    assert (sums <= limits.vector()).all() and sums[:, 0].sum() == sum(n for n, _ in sizes)
    full = sums == limits.vector()
    # Each limit is reached, in some sequences by itself.
    assert all((full[:, d] & (full.sum(1) == 1)).any() for d in range(3))


# --- fingerprints ------------------------------------------------------------------


def test_edited_texts_and_neighbours(docs):
    rng = random.Random(4)
    rows = [(i * 3 - 20, " ".join(f"wé{rng.randrange(300)}" for _ in range(rng.choice((0, 1, 4, 6, 30, 200))))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "a b c d e f g h")]
    shuffled = rng.sample(rows, len(rows))
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs(shuffled, CLASHING), in_place=True).collect()}
    assert len(found) == len(rows)
    for j, (i, text) in enumerate(rows):
        text = text or ""
        after, n = rows[(j + 1) % len(rows)], len(text)
        assert found[i].n_chars == n
        assert found[i].edited == text[: n - n // 2] + (after[1] or "")[: n // 2]
        a, b, e = set(found[i].anchors), set(found[after[0]].anchors), set(found[i].edited_anchors)
        assert sorted(a) == found[i].anchors
        assert found[i].near_next == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert found[i].near_edited == pytest.approx(len(a & e) / len(a | e) if a | e else 1.0)
    moved = fingerprints.fingerprints(docs([(1, "abcdefghijklmnopqrstuvwxyz" * 2), (2, "z")]), in_place=True)
    first = next(r for r in moved.collect() if r.doc_id == 1)
    # What stays is in place: anchors that end before the cut.
    own = docs([(1, "abcdefghijklmnopqrstuvwxyz" * 2)]).select(fingerprints.point_syncmers(F.col("text")).alias("a")).first().a
    assert first.in_place == sum(a.end < 26 for a in own)
    long = [found[i] for i, t in rows if t and len(t.split()) == 200]
    assert all(r.near_edited > 0.2 > r.near_next for r in long)


def test_point_syncmers_match_their_definition_and_join(spark):
    rng = random.Random(6)
    texts = ["", "a", "ab é😀", "x" * 40, "\n" * 13, "".join(rng.choice("ab c\né😀語") for _ in range(700))]
    texts += ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (5, 11, 12, 13, 30, 200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    shown = df.select(
        "i", fingerprints.point_syncmers(F.col("t")).alias("a"),
        F.expr("transform(sequence(1, 6 + length(t)), j -> xxhash64(encode(substr(concat(repeat('\\0', 11), t), j, 6), 'UTF-32')))").alias("m"),
    )
    for r in shown.collect():
        m, n = r.m, len(texts[r.i])
        assert [a.end for a in r.a] == [p for p in range(n) if min(m[p], m[p + 6]) <= min(m[p + 1 : p + 6])]
    pairs = df.alias("x").crossJoin(df.alias("y")).select(
        F.expr("left(x.t, length(x.t) - cast(floor(length(x.t) / 2) as int))").alias("head"), F.col("x.t").alias("own"),
        F.expr("left(y.t, cast(floor(length(x.t) / 2) as int))").alias("tail"), F.col("y.t").alias("next"),
    )
    whole = fingerprints.hashes_of(fingerprints.point_syncmers(F.concat("head", "tail")))
    parts = fingerprints.joined_anchors(
        F.col("head"), fingerprints.point_syncmers(F.col("own")), F.col("tail"), fingerprints.point_syncmers(F.col("next")))
    found = pairs.select(whole.alias("whole"), fingerprints.hashes_of(parts).alias("parts")).collect()
    assert len(found) == len(texts) ** 2 and all(r.whole == r.parts for r in found)


def test_short_and_unspaced_texts_stay_near_their_edits(docs):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(4, 9)))
    texts = [" ".join(word() for _ in range(n)) for n in range(3, 21) for _ in range(3)]
    texts += ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n)) for n in (20, 60, 400, 5_000)]
    rng.shuffle(texts)
    found = fingerprints.fingerprints(docs(list(enumerate(texts)))).collect()
    assert len(found) == len(texts)
    assert all(r.near_edited > max(0.1, r.near_next) for r in found)


def test_an_edit_moves_no_anchor_elsewhere(spark):
    text = " ".join(f"w{i}" for i in range(120))
    changed = text[:200] + "new " + text[200:]
    df = spark.createDataFrame([(0, text), (1, changed)], "i int, t string")
    a, b = (
        [(x.end, x.hash) for x in r.a]
        for r in df.select("i", fingerprints.point_syncmers(F.col("t")).alias("a")).orderBy("i").collect()
    )
    assert [x for x in a if x[0] < 200] == [x for x in b if x[0] < 200]
    assert [(p + 4, h) for p, h in a if p >= 212] == [x for x in b if x[0] >= 216]


def test_fingerprints_repeated_rows_null_ids_and_empty_tables(docs):
    rows = [(5, "same"), (5, "same"), (5, "other"), (None, "a b"), (7, "x " * 50_000)]
    found = fingerprints.fingerprints(docs(rows), in_place=True).collect()
    assert sorted(str(r.doc_id) for r in found) == ["5", "5", "5", "7", "None"]
    assert len({(r.edited, r.near_edited, r.in_place) for r in found if r.n_chars == 4 and r.doc_id == 5}) == 1
    assert {r.edited for r in found if r.doc_id is None} <= {"a bsam"[:2] + "s", "a bo"[:2] + "o"}
    assert fingerprints.fingerprints(docs([])).collect() == []
    one = fingerprints.fingerprints(docs([(1, "abcd")])).collect()
    assert (one[0].edited, one[0].near_next) == ("abab", 1.0)


def test_anchors_of_a_text_are_made_once_and_cross_blocks(docs, monkeypatch):
    rows = [(i, f"text {i * i} of its own, " * (i % 4)) for i in range(40)]
    whole = fingerprints.fingerprints(docs(rows), in_place=True)
    # Each text once, and the part across a cut.
    assert plan(fingerprints.fingerprints(docs(rows))).count("UTF-32") == 2
    monkeypatch.setattr(fingerprints, "BLOCK_POINTS", 50)
    small = fingerprints.fingerprints(docs(rows), in_place=True)
    assert sorted(small.collect()) == sorted(whole.collect())
    edited = {r.doc_id: r.edited for r in small.collect()}
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        assert edited[i] == text[: len(text) - len(text) // 2] + after[: len(text) // 2]


def test_fingerprints_are_native(docs):
    text = plan(fingerprints.fingerprints(docs([(1, "a b"), (2, "c")])))
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in text]


def test_texts_of_fingerprints_are_shuffled_once_in_blocks_by_number(docs, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_POINTS", 20)
    texts = [f"text {i * i} of its own, " * (i % 4) for i in range(40)]
    rows = [(None, "a"), (None, "b"), *[(i - 9, t) for i, t in enumerate(texts)], (50, "same"), (50, "same")]
    shown = plan(fingerprints.fingerprints(docs(rows[:-1])))
    assert shown.count("Exchange") == 1 and "Join" not in shown
    for kind in ("long", "string", "double", "date"):
        ids = F.date_add(F.lit("2024-01-01").cast("date"), F.col("doc_id").cast("int")) if kind == "date" else F.col("doc_id").cast(kind)
        df = docs(rows).withColumn("doc_id", ids)
        ordered = [r.text for r in df.distinct().orderBy("doc_id", F.xxhash64("text")).collect()]
        found = fingerprints.fingerprints(df)
        expected = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
        assert sorted(r.edited for r in found.select("edited").distinct().collect()) == sorted(set(expected))
        assert found.count() == len(rows)
        places = df.distinct().select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), F.char_length("text").alias("n"))
        # However many code points there are, the blocks are a few for each of 4 partitions.
        assert 4 < fingerprints.block_starts(places, places.agg(F.sum(F.col("n") + 1)).first()[0])[1] <= 20


def test_blocks_of_fingerprints_are_bounded_however_few_shuffle_partitions_there_are(docs, monkeypatch):
    rows = [(i, f"text {i * i} of its own, " * (1 + i % 4)) for i in range(200)]
    whole = sorted(fingerprints.fingerprints(docs(rows), in_place=True).collect())
    monkeypatch.setattr(fingerprints, "BLOCK_POINTS", 20)
    monkeypatch.setattr(fingerprints, "MOST_POINTS", 300, raising=False)
    points = sum(len(t) + 1 for _, t in rows)
    longest = max(len(t) + 1 for _, t in rows)
    places = docs(rows).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tie"), F.char_length("text").alias("n"))
    count = fingerprints.block_starts(places, points)[1]
    assert points // 300 <= count <= points // 300 + 1 + 4  # of 4 partitions, each begins a block
    found = fingerprints.fingerprints(docs(rows), in_place=True)
    assert sorted(found.collect()) == whole
    # A task has a few blocks, and there are more tasks than shuffle partitions.
    tasks = found.groupBy(F.spark_partition_id()).agg(F.sum(F.col("n_chars") + 1).alias("points")).collect()
    assert len(tasks) > 4
    assert max(t.points for t in tasks) <= (fingerprints.BLOCKS + 1) * (300 + longest)


def test_only_texts_of_repeated_rows_are_shuffled_before_those_of_fingerprints(docs, monkeypatch):
    rows = [(i, f"text {i * i} of its own, " * (i % 4)) for i in range(60)]
    texts = dict(rows)
    repeated = [(7, texts[7]), (7, texts[7]), (None, "a"), (None, "a"), (9, "another"), (None, "b")]
    marked, with_mark = [], getattr(fingerprints, "with_mark", None)
    monkeypatch.setattr(fingerprints, "with_mark", lambda *args: marked.append(with_mark(*args)) or marked[-1], raising=False)
    found = fingerprints.fingerprints(docs(rows + repeated)).collect()
    assert [sorted((str(r.id), r.text) for r in df.filter("again").collect()) for df in marked] == [
        [("7", texts[7])] * 3 + [("None", "a")] * 2
    ]
    assert len(found) == len(rows) + len(repeated)
    ids = [r.doc_id for r in found]
    assert (ids.count(7), ids.count(None), ids.count(9)) == (3, 3, 2)
    assert len({(r.edited, r.near_next) for r in found if r.doc_id == 7}) == 1
    once = {r.doc_id: r.edited for r in found if r.doc_id not in (7, 9, None)}
    assert all(once[i] == t[: len(t) - len(t) // 2] + texts[i + 1][: len(t) // 2] for i, t in rows[:-1] if i not in (7, 8, 9))
