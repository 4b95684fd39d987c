"""Quality classifier: hashed word n-grams, logistic regression by FTRL."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    WordTable, bounded_batches, hash_of, labelled_sample, mix, seeds, sums_by, text_of, texts_in,
)

HASH_BITS = 18
# Bound of the labelled sample; it is the only thing about the corpus that is bounded.
SAMPLE_ROWS = 6_000

_KIND = seeds(6, start=11)
_tables: dict[str, WordTable] = {}


def shape_of(word: str) -> str:
    """Letter case, digits and marks of a word, with runs of the same kind as one or two."""
    out: list[str] = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if out[-2:] != [kind, kind]:
            out.append(kind)
    return "".join(out)


def _describe(word: str) -> tuple[int, int]:
    return hash_of(word), hash_of(shape_of(word), 1)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of each text one after the other, and how many each has.

    Words, pairs of words, shapes, pairs of shapes, and words that repeat the
    one before; all hashed into ``2 ** HASH_BITS`` numbers.
    """
    table = _tables.setdefault("quality", WordTable(_describe, 2))
    words = [t.split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    facts = table.facts_of([w for run in words for w in run])
    text = np.repeat(np.arange(len(texts)), counts)
    pair = np.flatnonzero(text[:-1] == text[1:]) if len(text) else np.zeros(0, np.int64)
    word, shape = facts[:, 0], facts[:, 1]
    same = pair[word[pair] == word[pair + 1]]
    with np.errstate(over="ignore"):
        found = [
            (text, mix(word ^ _KIND[0])),
            (text[pair], mix(word[pair] * np.uint64(3) + word[pair + 1] ^ _KIND[1])),
            (text, mix(shape ^ _KIND[2])),
            (text[pair], mix(shape[pair] * np.uint64(3) + shape[pair + 1] ^ _KIND[3])),
            (text[same], np.full(len(same), _KIND[4])),
        ]
    owner = np.concatenate([o for o, _ in found])
    number = np.concatenate([n for _, n in found]) >> np.uint64(64 - HASH_BITS)
    order = np.argsort(owner, kind="stable")
    return number[order].astype(np.int64), np.bincount(owner, minlength=len(texts)).astype(np.int64)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Sparse dot product of weights and counts (over the root of their sum), squashed."""
        numbers, counts = features(texts)
        total = sums_by(self.weights[numbers], counts) / np.sqrt(np.maximum(counts, 1))
        return 1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -30, 30)))


def ftrl(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    passes: int = 3,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.1,
) -> QualityModel:
    """Follow the regularised leader, per coordinate, one example after the other.

    An example is its distinct feature numbers, their values and its label. The
    bias is one more coordinate, without penalties. No example: all scores 0.5.
    """
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    bias_z = bias_n = 0.0

    def solved(z, n):
        w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    for _ in range(passes):
        for numbers, values, label in examples:
            w = solved(z[numbers], n[numbers])
            bias = -bias_z * alpha / (beta + np.sqrt(bias_n))
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values + bias, -30, 30)))
            g = (p - label) * values
            z[numbers] += g - (np.sqrt(n[numbers] + g * g) - np.sqrt(n[numbers])) / alpha * w
            n[numbers] += g * g
            h = p - label
            bias_z += h - (np.sqrt(bias_n + h * h) - np.sqrt(bias_n)) / alpha * bias
            bias_n += h * h
    return QualityModel(
        solved(z, n).astype(np.float32), float(-bias_z * alpha / (beta + np.sqrt(bias_n)))
    )


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> QualityModel:
    """Fit on at most ``sample_rows`` labelled rows; ``keep`` is a condition on ``_key``, the id.

    Features are made where the texts are; the driver gets distinct numbers and
    values of the sample only and runs the updates in the order of the ids' hash.
    """
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("struct<numbers: array<int>, values: array<float>>")
    def sparse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            numbers, counts = features(texts_in(batch))
            out = []
            for run in np.split(numbers, np.cumsum(counts)[:-1]):
                distinct, times = np.unique(run, return_counts=True)
                values = times / np.sqrt(max(len(run), 1))
                out.append({"numbers": distinct.astype(np.int32), "values": values.astype(np.float32)})
            yield pa.array(
                out, pa.struct([("numbers", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])
            )

    sample = labelled_sample(docs, labels, label, keep, sample_rows, id_col, text_col)
    rows = sample.select("_key", "_label", sparse("_text").alias("x")).toArrow()
    column = {n: rows.column(n) for n in rows.column_names}
    numbers = [np.asarray(x["numbers"].values) for x in column["x"]]
    values = [np.asarray(x["values"].values, np.float64) for x in column["x"]]
    keys, marks = column["_key"].to_pylist(), column["_label"].to_pylist()
    order = sorted(range(len(keys)), key=lambda i: (hash_of(str(keys[i])), keys[i], marks[i], len(numbers[i])))
    return ftrl([(numbers[i], values[i], int(marks[i] == 1)) for i in order])


def quality_score(text: str | Column, model: QualityModel) -> Column:
    """Score from 0 to 1, higher for label 1. Null and empty texts get the bias's score."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(model.scores(texts_in(batch)), pa.float64())

    return score(text_of(text))


def score_quality(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``score``, ``predicted`` (1 from 0.5 on).

    Rows are scored one by one over their whole text: repeated rows and null ids
    get a row each, an empty table none. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    scored = docs.select(F.col(id_col), quality_score(text_col, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
