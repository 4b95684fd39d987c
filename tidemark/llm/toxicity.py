"""Toxicity by multiple-instance learning: sentences scored, documents labelled."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WordTable, bounded_batches, hash_of, labelled_sample, sums_by, text_of, texts_in,
)

HASH_BITS = 18
# Bound of the labelled sample; it is the only thing about the corpus that is bounded.
SAMPLE_ROWS = 6_000
PREFIX = 4
# A word or prefix in fewer documents of the sample has no weight.
LEAST_DOCS = 3

_BREAK = "\x00"
_END, _SILENT = 1, 2
# Up to a mark (and closing quotes or brackets) before white space, or up to a line end.
_SENTENCE = re.compile(r"(?s)\S.*?(?:[.!?][\"')\]}»”’]*(?=\s)|(?=\n)|\Z)")
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’¡¿…–—"
_tables: dict[str, WordTable] = {}


def _describe(word: str) -> tuple[int, int, int]:
    if word == _BREAK:
        return 0, 0, _END | _SILENT
    core = word.lower().strip(_MARKS)
    flags = (_END if word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?") else 0) | (0 if core else _SILENT)
    shift = 64 - HASH_BITS
    return hash_of(core) >> shift, hash_of(core[:PREFIX], 7) >> shift, flags


def sentences(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (word, prefix) of all words, each word's sentence, each sentence's text.

    A sentence ends after a word with ``.``, ``!`` or ``?`` at its end, at a line
    end and at the end of the text. A text without words has no sentence.
    """
    table = _tables.setdefault("toxicity", WordTable(_describe, 3))
    words = [t.replace("\n", f" {_BREAK} ").split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    facts = table.facts_of([w for run in words for w in run]).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), counts)
    ends = (facts[:, 2] & _END) > 0
    if len(text):
        ends[np.cumsum(counts)[counts > 0] - 1] = True
    sentence = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64) if len(text) else text
    heard = (facts[:, 2] & _SILENT) == 0
    owner = text[ends]
    # Sentences without a word, such as line ends alone, are no instances.
    full = np.zeros(len(owner), bool)
    full[sentence[heard]] = True
    number = np.cumsum(full) - 1
    return facts[heard, :2], number[sentence[heard]], owner[full]


@dataclass(frozen=True)
class ToxicityModel:
    word_weights: np.ndarray
    prefix_weights: np.ndarray
    bias: float
    floor: float

    def sentence_logits(self, found: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        weight = self.word_weights[found[:, 0]] + self.prefix_weights[found[:, 1]]
        return self.bias + np.bincount(sentence, weight, n)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Noisy-or over the sentences and a constant cause that every text has."""
        found, sentence, owner = sentences(texts)
        logits = self.sentence_logits(found, sentence, len(owner))
        quiet = np.bincount(owner, -np.logaddexp(0, logits), len(texts)) + np.log1p(-self.floor)
        return np.clip(-np.expm1(quiet), 0.0, 1.0)

    def locate(self, text: str, least: float = 0.5) -> list[tuple[int, int, float]]:
        """Sentences whose own score is at least ``least``: start, end (exclusive), score."""
        spans = [(m.start(), m.end()) for m in _SENTENCE.finditer(text)]
        if not spans:
            return []
        found, sentence, owner = sentences([text[a:b].replace("\n", " ") for a, b in spans])
        weight = self.word_weights[found[:, 0]] + self.prefix_weights[found[:, 1]]
        logits = self.bias + np.bincount(owner[sentence], weight, len(spans))
        scores = 1.0 / (1.0 + np.exp(-np.clip(logits, -30, 30)))
        return [(a, b, float(s)) for (a, b), s in zip(spans, scores, strict=True) if s >= least]


def fit(
    bags: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 150, rate: float = 1.0, sparing: float = 0.2
) -> ToxicityModel:
    """Maximum likelihood of the document labels, by full-batch adaptive gradients.

    A bag is a document's features, each feature row's sentence (from 0) and the
    label. Weights are kept sparse (L1): a feature needs to explain about
    ``sparing`` documents to get one. What has no weight after the first rounds,
    and whose gradient is far from giving it one, is left out of the others.
    Without any bag all scores are 0.5.
    """
    size = 1 << HASH_BITS
    if not bags:
        return ToxicityModel(np.zeros(size, np.float32), np.zeros(size, np.float32), -30.0, 0.5)
    label = np.array([y for _, _, y in bags], float)
    lengths = np.array([int(s[-1]) + 1 if len(s) else 0 for _, s, _ in bags], np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    found = np.concatenate([f for f, _, _ in bags]).astype(np.int64)
    sentence = np.concatenate([s + a for (_, s, _), a in zip(bags, first, strict=True)]).astype(np.int64)
    owner = np.repeat(np.arange(len(bags)), lengths)
    n = len(owner)

    number = np.concatenate([found[:, 0], found[:, 1] + size])
    place = np.concatenate([sentence, sentence])
    pairs = np.unique(number * len(bags) + owner[place]) // len(bags)
    common = np.bincount(pairs, minlength=2 * size) >= LEAST_DOCS
    used = common[number]
    number, place = number[used], place[used]
    names, number = np.unique(number, return_inverse=True)

    w, bias, floor = np.zeros(len(names)), -5.0, -6.0
    seen, bias_seen, floor_seen = np.ones(len(names)), 1.0, 1.0
    for turn in range(rounds):
        logits = bias + np.bincount(place, w[number], n)
        p = 1.0 / (1.0 + np.exp(-np.clip(logits, -30, 30)))
        p0 = 1.0 / (1.0 + np.exp(-floor))
        quiet = np.bincount(owner, -np.logaddexp(0, logits), len(bags)) + np.log1p(-p0)
        doc = np.clip(-np.expm1(quiet), 1e-9, 1.0)
        # Derivative of the log-likelihood by a sentence's logit: p (1 - P) / P for toxic, -p else.
        factor = np.where(label == 1, (1.0 - doc) / doc, -1.0)
        slope = factor[owner] * p
        g = np.bincount(number, slope[place], len(names))
        seen += np.where(w == 0, np.maximum(np.abs(g) - sparing, 0), g) ** 2
        step = rate / np.sqrt(seen)
        w += step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparing, 0)
        if turn in (15, 40):
            live = (w != 0) | (np.abs(g) > sparing / 2)
            names, w, seen = names[live], w[live], seen[live]
            here = live[number]
            place, number = place[here], (np.cumsum(live) - 1)[number[here]]
        for_bias, for_floor = slope.sum(), (factor * p0).sum()
        bias_seen += for_bias**2
        floor_seen += for_floor**2
        bias += rate * for_bias / np.sqrt(bias_seen)
        floor += rate * for_floor / np.sqrt(floor_seen)
    weights = np.zeros(2 * size, np.float32)
    weights[names] = w
    return ToxicityModel(weights[:size], weights[size:], float(bias), float(1.0 / (1.0 + np.exp(-floor))))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows; ``keep`` is a condition on ``_key``, the id."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<words: array<int>, prefixes: array<int>, sentence: array<int>>")
    def bag(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for text in texts_in(batch):
                found, sentence, _ = sentences([text])
                out.append({"words": found[:, 0], "prefixes": found[:, 1], "sentence": sentence})
            yield pa.array(
                out, pa.struct([(x, pa.list_(pa.int32())) for x in ("words", "prefixes", "sentence")])
            )

    sample = labelled_sample(docs, labels, label, keep, sample_rows, id_col, text_col)
    rows = sample.select("_key", "_label", bag("_text").alias("x")).toArrow()
    keys, marks, bags = (rows.column(c) for c in ("_key", "_label", "x"))
    keys, marks = keys.to_pylist(), marks.to_pylist()
    found = []
    for i in range(len(keys)):
        words, prefixes, sentence = (np.asarray(bags[i][c].values) for c in ("words", "prefixes", "sentence"))
        found.append((np.stack([words, prefixes], 1), sentence, int(marks[i] == 1)))
    order = sorted(range(len(keys)), key=lambda i: (keys[i], marks[i], len(found[i][1])))
    return fit([found[i] for i in order])


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    least: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, ``score``, ``predicted`` (1 from 0.5 on) and the offending ``sentences``.

    ``sentences`` lists start, end (code points, end exclusive) and score of the
    sentences with a score of at least ``least``. Null and empty texts have no
    sentence and get the score of the constant cause. Rows are scored one by one
    over their whole text; repeated rows and null ids get a row each. Other
    columns are ignored; an empty table gives no row.
    """
    bounded_batches(docs.sparkSession)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    @F.arrow_udf("struct<score: double, sentences: array<struct<start: long, end: long, score: double>>>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = texts_in(batch)
            scores = model.scores(texts)
            spans = [
                [dict(zip(("start", "end", "score"), x, strict=True)) for x in model.locate(t, least)]
                if s >= min(least, 0.5) / 2 else []
                for t, s in zip(texts, scores, strict=True)
            ]
            yield pa.StructArray.from_arrays(
                [pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], ["score", "sentences"]
            )

    judged = docs.select(F.col(id_col), judge(text_of(text_col)).alias("_judged"))
    return judged.select(
        id_col,
        F.col("_judged.score").alias("score"),
        (F.col("_judged.score") >= 0.5).cast("int").alias("predicted"),
        F.col("_judged.sentences").alias("sentences"),
    )
