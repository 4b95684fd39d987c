"""What the text operators share: whole texts, batch sizes, word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A worker keeps at most so many distinct words of what it has seen.
REMEMBERED = 300_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def bounded_batches(spark: SparkSession, rows: int = 500, megabytes: int = 4) -> None:
    """Keep Arrow batches small: texts may be very long, workers hold one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str | Column) -> Column:
    """The whole text; null counts as empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit(""))


def texts_in(batch: pa.Array) -> list[str]:
    return [t or "" for t in batch.to_pylist()]


def fold(key: int | None, modulus: int) -> int | None:
    """crc32 of the id as text, modulo; what ``crc32(cast(id as string)) % modulus`` gives."""
    import zlib

    return None if key is None else zlib.crc32(str(key).encode()) % modulus


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    return mix(np.arange(start, start + n, dtype=np.uint64) * _GOLDEN)


class WordTable(dict):
    """Words to rows of facts, each word described once per worker.

    ``describe`` maps a word to ``width`` numbers. The table starts anew beyond
    ``most`` words, so its memory is bounded; facts depend on the word alone, so
    results don't change.
    """

    def __init__(self, describe, width: int | tuple, dtype=np.uint64, most: int = REMEMBERED):
        super().__init__()
        self.describe, self.most = describe, most
        self.facts = np.zeros((4096, *np.atleast_1d(width)), dtype)

    def __missing__(self, word):
        row = len(self)
        if row == len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        self.facts[row] = self.describe(word)
        self[word] = row
        return row

    def facts_of(self, words: list) -> np.ndarray:
        """A row of facts for each word."""
        if len(self) > self.most:
            self.clear()
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return self.facts[rows]


def hash_of(data: bytes | str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(data, seed)


LONG_WORD = 256


def ascii_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts in turn, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    ends = np.asarray(lists.offsets)
    words = lists.flatten()
    full = np.asarray(pc.greater(pc.binary_length(words), 0)) if len(words) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(full)])
    ends = ends - ends[0]
    counts = kept[ends[1:]] - kept[ends[:-1]]
    return (words if full.all() else words.filter(pa.array(full))), counts.astype(np.int64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, taken eight bytes at a time over all words at once."""
    if not len(words):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    start, length = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    data = np.concatenate([np.frombuffer(words.buffers()[2], np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    out = mix(length.astype(np.uint64) * _GOLDEN)
    live = np.flatnonzero(length <= LONG_WORD) if length.max() > LONG_WORD else np.arange(len(words))
    at = 0
    while len(live):
        rest = length[live] - at
        part = eight[start[live] + at]
        short = rest < 8
        part[short] &= (np.uint64(1) << (np.uint64(8) * rest[short].astype(np.uint64))) - np.uint64(1)
        out[live] = mix((out[live] ^ part) * _MIX_2 + _GOLDEN)
        at += 8
        live = live[rest > 8]
    for i in np.flatnonzero(length > LONG_WORD):
        out[i] = hash_of(words[int(i)].as_py())
    return out


def starts_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)


def sums_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts`` values; 0 for an empty run."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int, id_col: str, text_col: str
) -> DataFrame:
    """At most ``most`` labelled rows (id, text, label), chosen by a hash of the id.

    Only rows that ``keep`` admits; rows without id or label are left out. The
    chosen ids are at most ``most`` rows, which bounds the broadcast.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_key"), F.col(label).cast("int").alias("_label"))
        .filter(F.col("_key").isNotNull() & F.col("_label").isNotNull())
        .filter(keep)
        .orderBy(F.xxhash64("_key"), "_key", "_label")
        .limit(most)
    )
    texts = docs.select(F.col(id_col).alias("_key"), text_of(text_col).alias("_text"))
    return texts.join(F.broadcast(chosen), "_key")
