"""Classifiers, language model and personal data: held-out accuracy and brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from text_fixtures import docs  # noqa: F401

from tidemark.llm import masked_lm, pii, quality, toxicity

CLASHING = ("score", "predicted", "held_out", "sentences", "pii", "n_tokens", "log_prob", "_text", "_key", "_label")
EDGES = [(None, "null id"), (900_001, None), (900_002, ""), (900_003, " \n\n"), (900_004, "w " * 100_000),
         (900_005, "same"), (900_005, "same")]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, score string")


def words(rng, n):
    return [rng.choice(("ka", "lo", "mi", "nu", "te")) + rng.choice(("ra", "so", "ti")) for _ in range(n)]


# --- quality -----------------------------------------------------------------------


def test_quality_finds_held_out_junk(spark, docs):
    rng = random.Random(4)
    rows, marks = [], []
    for i in range(300):
        w = words(rng, 60)
        if i % 3 == 0:
            text = " ".join(rng.choice([[x.upper() + "!!" for x in w], [x + "###" for x in w], [w[0]] * 60]))
        else:
            text = " ".join(w).capitalize() + "."
        rows.append((i, text))
        marks.append((i, int(i % 3 != 0), 0, "x"))
    df = docs([*rows, *EDGES], CLASHING)
    keep = F.crc32(F.col("_key").cast("string")) % 3 != 1
    marked = labelled(spark, [*marks, (900_001, None, None, "x"), (None, 1, 0, "x")])
    model = quality.train_quality(df, marked, keep)
    found = quality.score_quality(df, model).collect()
    assert len(found) == len(rows) + len(EDGES) and all(0 <= r.score <= 1 for r in found)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    by_id = {r.doc_id: r for r in found}
    assert len(held) > 60 and sum(by_id[i].predicted == int(i % 3 != 0) for i in held) >= 0.97 * len(held)
    empty = 1 / (1 + math.exp(-model.bias))
    assert by_id[900_001].score == by_id[900_002].score == by_id[900_003].score == pytest.approx(empty)
    assert len({r.score for r in found if r.doc_id == 900_005}) == 1


def test_quality_without_labels_or_rows(spark, docs):
    model = quality.train_quality(docs([]), labelled(spark, []), F.lit(True))
    assert quality.score_quality(docs([]), model).collect() == []
    assert quality.score_quality(docs([(1, "a b")]), model).collect()[0].score == 0.5


def test_ftrl_takes_the_steps_of_its_definition():
    """Two coordinates and the bias, by hand: z, n and the closed form of each weight, over two passes."""
    alpha, beta, l1, l2 = 0.3, 1.0, 0.05, 0.1
    examples = [({3: 2.0}, 1), ({3: 1.0, 7: 0.5}, 0), ({7: 3.0}, 0), ({3: 2.0, 7: 1.0}, 1), ({7: 0.01}, 1)]
    z, n, bias_z, bias_n = {3: 0.0, 7: 0.0}, {3: 0.0, 7: 0.0}, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(2):
        for values, label in examples:
            w = {i: weight(i) for i in values}
            bias = -bias_z / ((beta + math.sqrt(bias_n)) / alpha)
            slope = 1 / (1 + math.exp(-(sum(w[i] * x for i, x in values.items()) + bias))) - label
            for i, x in values.items():
                g = slope * x
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
            bias_z += slope - (math.sqrt(bias_n + slope * slope) - math.sqrt(bias_n)) / alpha * bias
            bias_n += slope * slope
    model = quality.ftrl([(np.array(list(v)), np.array(list(v.values())), label) for v, label in examples], passes=2)
    assert [model.weights[i] for i in (3, 7)] == pytest.approx([weight(3), weight(7)])
    assert model.bias == pytest.approx(-bias_z / ((beta + math.sqrt(bias_n)) / alpha))
    assert np.flatnonzero(model.weights).tolist() == [3, 7]
    # A coordinate that never gets beyond the first penalty has no weight.
    assert not quality.ftrl([(np.array([3]), np.array([0.05]), 1)], passes=1).weights.any()


def test_quality_features_are_counted_per_text():
    numbers, counts = quality.features(["a a b", "", "B!!"])
    # words, pairs, shapes, shape pairs, and the repeat
    assert counts.tolist() == [3 + 2 + 3 + 2 + 1, 0, 2]
    alone, _ = quality.features(["B!!"])
    assert sorted(numbers[-2:]) == sorted(alone)
    assert quality.shape_of("EDTH!!") == "AA!!" and quality.shape_of("anor***") == "aa**"


# --- toxicity ----------------------------------------------------------------------


def test_toxicity_learns_sentences_from_document_labels(spark, docs):
    rng = random.Random(8)
    bad = ["vileone", "grimtwo", "foulthree"]
    rows, marks = [], []
    for i in range(700):
        lines = [" ".join(words(rng, 8)).capitalize() + "." for _ in range(rng.randrange(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(lines))
            lines[at] = lines[at][:-1] + f" {rng.choice(bad)}!"
        rows.append((i, " ".join(lines)))
        marks.append((i, 1, int(toxic), "x"))
    df = docs([*rows, *EDGES], CLASHING)
    keep = F.crc32(F.col("_key").cast("string")) % 5 != 0
    model = toxicity.train_toxicity(df, labelled(spark, marks), keep)
    found = {r.doc_id: r for r in toxicity.score_toxicity(df, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(found[i].predicted == int(i % 4 == 0) for i in held) >= 0.97 * len(held)
    texts = dict(rows)
    located = [[texts[i][s.start : s.end] for s in found[i].sentences] for i in held if i % 4 == 0]
    assert sum(len(x) == 1 and any(b in x[0] for b in bad) for x in located) >= 0.9 * len(located)
    for i in (900_001, 900_002, 900_003):
        assert found[i].score == pytest.approx(model.floor, abs=1e-6) and found[i].sentences == []


def test_noisy_or_of_the_sentences():
    zero = np.zeros(1 << toxicity.HASH_BITS, np.float32)
    weights = zero.copy()
    found, _, _ = toxicity.sentences(["bad"])
    weights[found[0, 0]] = 4.0
    model = toxicity.ToxicityModel(weights, zero, -3.0, 0.01)
    s = lambda x: 1 / (1 + math.exp(-x))
    text = "Fine here. A bad one! bad\nand \"bad.\" good"
    quiet = (1 - s(-3)) * (1 - s(1)) ** 3 * (1 - s(-3)) * (1 - 0.01)
    assert model.scores([text, "", "ok"]) == pytest.approx([1 - quiet, 0.01, 1 - (1 - s(-3)) * 0.99], abs=1e-6)
    assert [text[a:b] for a, b, _ in model.locate(text)] == ["A bad one!", "bad", 'and "bad."']


def test_toxicity_without_labels_or_rows(spark, docs):
    model = toxicity.train_toxicity(docs([]), labelled(spark, []), F.lit(True))
    assert toxicity.score_toxicity(docs([]), model).collect() == []
    assert toxicity.score_toxicity(docs([(1, "a")]), model).collect()[0].score == pytest.approx(0.5)


# --- language model ----------------------------------------------------------------


def test_language_model_prefers_text_like_its_corpus(spark, docs):
    rng = random.Random(3)
    order = {f"w{i}": f"w{(i * 7 + 1) % 40}" for i in range(40)}

    def sentence():
        w, out = f"w{rng.randrange(40)}", []
        for _ in range(60):
            out.append(w)
            w = order[w]
        return out

    rows = [(i, " ".join(sentence())) for i in range(6_000)]
    model = masked_lm.train_language_model(docs(rows, CLASHING))
    good = [sentence() for _ in range(20)]
    mixed = [rng.sample(s, len(s)) for s in good]
    tests = [*((i, " ".join(s)) for i, s in enumerate(good)), *((100 + i, " ".join(s)) for i, s in enumerate(mixed))]
    found = {r.doc_id: r for r in masked_lm.score_language(docs([*tests, *EDGES], CLASHING), model).collect() if r.doc_id is not None}
    assert all(found[i].mean_log_prob > found[100 + i].mean_log_prob for i in range(20))
    assert found[0].mean_log_prob > -math.log(40)  # better than each word's frequency alone
    assert found[0].n_tokens == 60 and found[900_004].n_tokens == 100_000
    for i in (900_001, 900_002, 900_003):
        assert (found[i].n_tokens, found[i].log_prob, found[i].mean_log_prob) == (0, 0.0, None)


def test_language_model_of_an_empty_table(docs):
    model = masked_lm.train_language_model(docs([]))
    assert masked_lm.score_language(docs([]), model).collect() == []
    assert masked_lm.score_language(docs([(1, "new words")]), model).collect()[0].n_tokens == 2


def test_word_counts_are_exact(docs):
    rows = [(1, "a b a"), (2, None), (3, "b\tc\n a"), (4, ""), (5, "é a")]
    found = {r.word: r.n for r in masked_lm.word_counts(docs(rows)).collect()}
    assert found == {"a": 4, "b": 2, "c": 1, "é": 1}


def test_hashed_words_are_scored_by_their_own_counts(docs, monkeypatch):
    monkeypatch.setattr(masked_lm, "KNOWN", 800)
    words = [f"w{i}" for i in range(1_200)]
    times = [40 if i < 700 else 30 if i < 800 else 2 + i % 7 if i < 1_100 else 1 for i in range(1_200)]
    bag = [w for w, n in zip(words, times, strict=True) for _ in range(n)]
    random.Random(5).shuffle(bag)
    rows = docs([(i, " ".join(bag[i * 300 : i * 300 + 300])) for i in range(len(bag) // 300 + 1)])
    model = masked_lm.train_language_model(rows)
    assert 0 < len(model.vocabulary.known) <= 800  # so some counts are joined
    top = {w for w, _ in sorted(zip(words, times, strict=True), key=lambda x: (-x[1], x[0]))[: masked_lm.TOKENS - 1 - masked_lm.RARE]}
    tests = [*words[750:], "unseen"]
    number = dict(zip(tests, masked_lm.rare_numbers(masked_lm.word_hashes(pa.array(tests))), strict=True))
    found = {r.doc_id: r.log_prob for r in masked_lm.score_language(docs(list(enumerate(tests))), model).collect()}
    behind = {}
    for i, w in enumerate(tests):
        if w not in top:
            behind.setdefault(number[w], []).append((found[i], dict(zip(words, times, strict=True)).get(w, 1)))
    compared = 0
    for same in behind.values():
        for (a, m), (b, n) in itertools.combinations(same, 2):
            assert a - b == pytest.approx(math.log(m / n), abs=3e-3)
            compared += m != n
    assert compared > 50


def test_log_probabilities_add_up_and_gradients_are_right():
    rng = np.random.default_rng(1)
    fresh = masked_lm.Network.fresh()
    net = fresh.with_flat(fresh.flat() + rng.normal(0, 0.1, fresh.flat().size))
    stream = rng.integers(0, masked_lm.TOKENS, 40)
    total = 0.0
    for t in range(masked_lm.TOKENS):
        total += math.exp(net.log_probs(np.array([3, 9, t, 700, 20]))[0])
    assert total == pytest.approx(1.0, abs=1e-3)
    at = np.arange(2, 38)
    grads = np.concatenate([g.ravel() for g in net.gradients(stream, at)])
    flat = net.flat().astype(float)
    for i in np.argsort(-np.abs(grads))[[0, 30, 300]]:
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-2
        down[i] -= 1e-2
        slope = (net.with_flat(up).log_probs(stream).mean() - net.with_flat(down).log_probs(stream).mean()) / 2e-2
        assert grads[i] == pytest.approx(slope, rel=0.02)


def test_every_place_of_every_text_is_a_target_of_training(monkeypatch):
    seen, true = [], masked_lm.Network.gradients

    def noted(self, stream, at):
        seen.extend(stream[at].tolist())
        return true(self, stream, at)

    monkeypatch.setattr(masked_lm.Network, "gradients", noted)
    tokens, counts = np.arange(1, 10_001) % 1_000 + 1, np.array([3, 0, 1, 9_000, 996])
    trainer = masked_lm.Trainer(masked_lm.Network.fresh())
    trainer.take(tokens, counts)
    assert seen == tokens.tolist() and trainer.tokens == 10_000


def test_scores_of_documents_by_hand(docs):
    """Every token's hidden state, class and member, one number after the other."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(1500)]
    texts = [" ".join(rng.choice(vocabulary[: 40 * (1 + i)]) for _ in range(rng.randrange(1, 60))) for i in range(40)] + [""]
    rows = list(enumerate(texts))
    model = masked_lm.train_language_model(docs(rows))
    counted = Counter(w for t in texts for w in t.split())
    net, spread = model.network, model.vocabulary.spread

    def log_soft(row, at):
        top = max(row)
        return row[at] - top - math.log(sum(math.exp(x - top) for x in row))

    def score(text):
        words = text.split()
        tokens, counts = model.vocabulary.numbers(pa.array([text]))
        assert counts.tolist() == [len(words)]
        around = [0, 0, *tokens.tolist(), 0, 0]
        total = 0.0
        for place, (word, token) in enumerate(zip(words, tokens.tolist())):
            h = [
                math.tanh(net.hidden[d] + sum(net.reach[k, d] * net.embed[around[place + 2 + o], d] for k, o in enumerate((-2, -1, 1, 2))))
                for d in range(masked_lm.WIDTH)
            ]
            group, member = divmod(token, masked_lm.CLASSES)
            total += log_soft([float(np.dot(h, net.to_class[:-1, c]) + net.to_class[-1, c]) for c in range(masked_lm.CLASSES)], group)
            inner = net.to_member[group]
            total += log_soft([float(np.dot(h, inner[:-1, m]) + inner[-1, m]) for m in range(masked_lm.CLASSES)], member)
            if token <= masked_lm.RARE:
                total += math.log(counted[word]) - spread[token]
        return total

    for r in masked_lm.score_language(docs(rows), model).collect():
        assert r.n_tokens == len(texts[r.doc_id].split())
        assert r.log_prob == pytest.approx(score(texts[r.doc_id]), abs=0.02), texts[r.doc_id]


def test_scores_do_not_depend_on_the_texts_beside():
    vocabulary = masked_lm.Vocabulary(np.zeros(0, np.uint64), np.zeros(masked_lm.TOKENS))
    rng = np.random.default_rng(2)
    fresh = masked_lm.Network.fresh()
    model = masked_lm.LanguageModel(vocabulary, fresh.with_flat(fresh.flat() + rng.normal(0, 0.1, fresh.flat().size)))
    texts = ["a b c d", "", "e", "f g " * 30_000]
    _, together = model.scores(pa.array(texts))
    alone = [model.scores(pa.array([t]))[1][0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-4)


# --- personal data -----------------------------------------------------------------

# The base patterns as they are stated, matched plainly.
PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
                if not 13 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


PARTS = ["a@b.c", "@", ".", "a.b", "-", "+", "1", "255", "256", "0007", "4111 1111 1111 1111", "4111-1111-1111-1112",
         "+1 (202) 555-0143", "+", " ", "x@y", "x@y.z.", "10.0.0.1", "1.2.3", "\n", "é", "%", "٣", "(", ")", "a@a@b.co"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14))
def test_base_spans_are_those_of_the_plain_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_spans(text)


def test_labelled_table_is_learned_and_other_forms_are_added():
    crf = pii.train_crf()
    tagger = pii.Tagger(crf)
    for line in pii.LABELLED.splitlines():
        text = re.sub(r"\[(?:email|ip|card|phone):([^\]]*)\]", r"\1", line)
        want = re.findall(r"\[(email|ip|card|phone):([^\]]*)\]", line)
        assert [(k, text[a:b]) for k, a, b in tagger.spans([text])[0]] == want
    text = "call (303) 555-0100 or +1 (569) 555-6633 4795326016703902 in 1999."
    found = [(k, text[a:b], base) for k, a, b, base in pii.spans_in([text], crf)[0]]
    # The base patterns take the last phone and card together, which is neither.
    assert ("phone", "(303) 555-0100", False) in found
    assert ("phone", "+1 (569) 555-6633", False) in found and len(found) == 3
    clean = "The 3 mills of 1843, rebuilt in 2001 (see chapter 4), ran 24 hours."
    assert pii.spans_in([clean, ""], crf) == [[], []]


def test_facts_are_those_of_the_whole_word():
    assert "digits=20+" in pii.facts(pii.shape("1" * 20)) and "digits=13-19" in pii.facts(pii.shape("1" * 19))
    start = "a-1" * 12  # its 36 runs are cut after 24
    plain, more = (pii.facts(pii.shape(w)) for w in (start, start + "a@b.c#d"))
    assert plain[1] == more[1]
    assert {"digits=9-12", "marks=-", "dots=0", "at=False"} <= set(plain)
    assert {"digits=9-12", "marks=#-.@", "dots=1", "at=True"} <= set(more)
    assert pii.shape("4111-1111") == "d4-d4" and "\n" not in pii.shape("a.b@c.example")


def test_added_spans_overlap_no_base_span():
    rng = random.Random(3)
    for _ in range(200):
        spans = lambda n: [("ip", a, a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(n))]  # noqa: E731, B023
        base, more = spans(rng.randrange(6)), spans(8)
        want = [s for s in more if not any(a < s[2] and s[1] < b for _, a, b in base)]
        found = [s[:3] for s in pii.with_added(base, more) if not s[3]]
        assert sorted(found) == sorted(want)


def test_viterbi_finds_the_best_of_all_paths():
    tagger = pii.Tagger(pii.train_crf())
    crf, k = tagger.crf, len(pii.LABELS)
    lines = [["call", "(303)", "555-0100", "now"], ["ip", "10.0.0.1"], ["4111", "1111", "word"], ["word"], [],
             ["a@b.example.com"], ["+1", "(212)", "555-0100", "x"]]
    paths = tagger.paths(lines)
    for i, line in enumerate(lines):
        if not line:
            assert i not in paths
            continue
        parts = [crf.emission(pii.shape(w)) for w in line]
        em = [p[0].copy() for p in parts]
        for t in range(len(line)):
            em[t] += parts[t - 1][1] if t else 0
            em[t] += parts[t + 1][2] if t + 1 < len(line) else 0

        def value(path, em=em):
            start = pii.allowed()[0][path[0]]
            return start + sum(em[t][y] for t, y in enumerate(path)) + sum(crf.moves[a, b] for a, b in zip(path, path[1:], strict=False))

        best = max(itertools.product(range(k), repeat=len(line)), key=value)
        assert tuple(paths.get(i, np.zeros(len(line), int))) == best


def test_pii_in_documents(docs):
    long = "word " * 50_000 + "end@mail.example.com"
    rows = [(1, "Write a.b@mail.example.com, ring +1 (202) 555-0143\nfrom 10.0.0.1"), (2, long), *EDGES]
    found = {r.doc_id: r for r in pii.find_pii(docs(rows, CLASHING)).collect()}
    assert [(s.kind, s.start, s.end, s.base) for s in found[1].pii] == [
        ("email", 6, 26, True), ("ip", 56, 64, True), ("phone", 33, 50, True)
    ]
    assert [(s.kind, s.start) for s in found[2].pii] == [("email", 250_000)]
    assert found[900_001].pii == found[900_002].pii == []
    clean = docs(rows).select("doc_id", pii.redact_pii("text").alias("text")).collect()
    assert [r.text for r in clean if r.doc_id == 1] == ["Write <email>, ring <phone>\nfrom <ip>"]
    assert [r.text for r in clean if r.doc_id == 900_001] == [""]
    assert pii.find_pii(docs([])).collect() == []
