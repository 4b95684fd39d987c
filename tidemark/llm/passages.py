"""Substring dedup: repeated passages of words, found by anchors on a difference cover."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ascii_words, bounded_batches, mix, starts_of, text_of, word_hashes
from tidemark.llm.native import maybe_among, with_mark
from tidemark.session import written

WINDOW = 20
# A perfect difference cover: every difference modulo the period is one between two of
# these places, so two texts that match from i and from j on both have an anchor at the
# same distance, below the period, behind i and j.
PERIOD = 13
COVER = (0, 1, 3, 9)

_FACTOR = np.uint64(0x2545F4914F6CDD1D)


def rolled(hashed: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A hash of each run of ``length`` words, by doubling: runs of 1, 2, 4, ... words."""
    size, power = 0, mix(hashed ^ np.uint64(seed))
    out, width = None, 1
    while True:
        if length & width:
            if out is None:
                out, size = power, width
            else:
                n = len(hashed) - size - width + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                out, size = mix(out[:n] * _FACTOR ^ power[size : size + n]), size + width
        if size == length:
            return out
        n = len(power) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        power, width = mix(power[:n] * _FACTOR ^ power[width : width + n]), 2 * width


class Words:
    """The words of a batch of texts: hashes, which text each is of, and its place there."""

    def __init__(self, texts: pa.Array):
        self.flat, self.counts = ascii_words(texts)
        self.hashed = word_hashes(self.flat)
        self.starts = starts_of(self.counts)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(len(self.hashed)) - self.starts[self.owner]

    def runs(self, length: int) -> np.ndarray:
        """Numbers of the words at which a run of so many words of one text starts."""
        return np.flatnonzero(self.place + length <= self.counts[self.owner])


def anchors_of(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words at which an anchor starts, and the anchors' hashes."""
    length = window - PERIOD + 1
    at = words.runs(length)
    at = at[np.isin(words.place[at] % PERIOD, COVER)]
    return at, rolled(words.hashed, length, 1)[at]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words of each text, and a hash of 128 bits of their sequence."""
    for batch in batches:
        words = Words(batch.column("text"))
        at = mix(words.place.astype(np.uint64) + np.uint64(1))
        n, owner = len(words.counts), words.owner
        sums = []
        for seed in (11, 12):
            total = np.zeros(n, np.uint64)
            np.add.at(total, owner, mix(words.hashed * _FACTOR ^ at ^ np.uint64(seed)))
            sums.append(pa.array(total.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("tie"), pa.array(words.counts), *sums], ["id", "tie", "n", "s1", "s2"]
        )


def _anchors(window: int, with_place: bool):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("text"))
            at, hashes = anchors_of(words, window)
            out = [pa.array(hashes.view(np.int64))]
            if with_place:
                key = np.asarray(batch.column("key"))
                out += [pa.array(key[words.owner[at]]), pa.array(words.place[at].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["anchor", "key", "place"][: len(out)])

    return anchors


def _windows(window: int):
    """Windows around the anchors of a text that occur again: two hashes and the start."""
    reach = PERIOD - 1

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("text"))
            asked = batch.column("places")
            flat, lengths = np.asarray(asked.flatten()), np.asarray(pc.list_value_length(asked))
            # Places that hang on another text of the same id may lie behind this text.
            of = np.repeat(np.arange(len(lengths)), lengths)
            inside = flat < words.counts[of]
            flat, of = flat[inside], of[inside]
            marks = np.zeros(len(words.hashed) + 1, np.int64)
            at = words.starts[of] + flat
            np.add.at(marks, at - np.minimum(flat, reach), 1)
            np.add.at(marks, at + 1, -1)
            near = np.cumsum(marks)[:-1] > 0
            start = words.runs(window)
            start = start[near[start]]
            first, second = (rolled(words.hashed, window, seed)[start] for seed in (2, 3))
            base = np.asarray(batch.column("base"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first.view(np.int64)), pa.array((second >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    pa.array(base[words.owner[start]]), pa.array(words.place[start].astype(np.int32)),
                ],
                ["w1", "w2", "base", "start"],
            )

    return windows


def _kept(window: int):
    """The words that no window in ``gone`` covers; all go of a ``copy``."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column("text"))
            gone = batch.column("gone")
            lengths = np.asarray(pc.fill_null(pc.list_value_length(gone), 0))
            of = np.repeat(np.arange(len(lengths)), lengths)
            at = words.starts[of] + np.asarray(gone.flatten()).astype(np.int64)
            marks = np.zeros(len(words.hashed) + 1, np.int64)
            np.add.at(marks, at, 1)
            np.add.at(marks, at + window, -1)
            stays = np.cumsum(marks)[:-1] == 0
            stays &= ~np.asarray(batch.column("copy"))[words.owner]
            left = np.bincount(words.owner[stays], minlength=len(words.counts))
            cuts = pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(cuts, words.flat.filter(pa.array(stays)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.binary_join(lists, " "), pa.array(words.counts), pa.array(words.counts - left)],
                ["id", "text", "n_words", "n_removed"],
            )

    return kept


def in_order(texts: DataFrame) -> DataFrame:
    """``base`` for rows (id, tie, n): the words of all texts before, ascending by id (nulls first) and tie.

    Rows are dealt out by ranges and written; sums run within a range and are
    handed on by one row a range.
    """
    ranges = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.repartitionByRange(ranges, "id", "tie").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "passage-order")
    # One more for each text, so that no two begin at the same place.
    words = F.col("n") + 1
    inside = dealt.withColumn("upto", F.sum(words).over(W.partitionBy("part").orderBy("id", "tie")))
    totals = dealt.groupBy("part").agg(F.sum(words).alias("words"))
    earlier = F.coalesce(F.sum("words").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = inside.join(totals.select("part", earlier.alias("earlier")), "part")
    return placed.withColumn("base", F.col("earlier") + F.col("upto") - words).drop("part", "upto", "earlier")


def _row_key(id_col: Column, tie: Column, kind: T.DataType) -> Column:
    """A long to meet by: the id where it is a whole number; different texts may share it."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(id_col.cast("long"), tie)
    return F.coalesce(F.xxhash64(id_col), tie)


def dedup_passages(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``text`` (the words that stay, joined by a space), ``n_words``, ``n_removed``.

    Words lie between ASCII white space and are compared as they are. A window is
    ``window`` consecutive words of one text. Each word that a window covers whose
    words also start earlier (in a smaller id, or before in the same text) goes;
    windows are judged on the whole input.

    Anchors of ``window`` - 12 words are hashed at the cover's places modulo 13
    only, 4 of 13. Two equal windows hold the same anchor at the same distance
    from their starts, since the cover has a pair of places for every difference;
    so a window none of whose anchors occurs twice occurs once. Round the anchors
    that do, the match is extended: windows are compared as a whole, by 96 bits of
    hash, and each learns the earliest place that has its words. Counting anchors
    and finding the earliest place both group within tasks before they shuffle,
    and no two occurrences are ever paired, so a passage in a third of all texts
    is no large group anywhere. Texts with the same words as an earlier one go as
    a whole; their windows start earlier there.

    Null counts as a text without words. A null id comes before all others. Rows
    that share an id and a text are one text: what one keeps the other keeps too.
    Rows that share only the id follow each other by a hash of the text. Texts
    shorter than a window keep all words. Other columns are ignored; an empty
    table gives an empty result.
    """
    if window < PERIOD:
        raise ValueError(f"a window holds {PERIOD} words or more")
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("tie"), "text")
    rows = rows.withColumn("key", _row_key(F.col("id"), F.col("tie"), kind))
    id_field = T.StructField("id", kind)

    def schema(ddl: str, *first: T.StructField) -> T.StructType:
        return T.StructType([*first, *T.StructType.fromDDL(ddl).fields])

    # What each text is, where it stands, and whether an earlier one has the same words.
    facts = rows.select("id", "tie", "text").mapInArrow(_facts, schema("tie long, n long, s1 long, s2 long", id_field))
    placed = written(in_order(facts.distinct()), "passage-places")
    same = ["n", "s1", "s2"]
    firsts = placed.filter(F.col("n") >= window).groupBy(*same).agg(
        F.min("base").alias("first"), F.count(F.lit(1)).alias("times")
    )
    placed = placed.join(firsts.filter("times > 1").drop("times").hint("merge"), same, "left").select(
        "id", "tie", "base", F.coalesce(F.col("base") > F.col("first"), F.lit(False)).alias("copy")
    )
    placed = written(placed.withColumn("key", _row_key(F.col("id"), F.col("tie"), kind)), "passage-texts")

    # Anchors that occur twice, and where.
    anchors = rows.select("text").mapInArrow(_anchors(window, False), schema("anchor long"))
    twice = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("anchor")
    twice = written(twice, "passage-anchors")
    found = rows.select("key", "text").mapInArrow(_anchors(window, True), schema("anchor long, key long, place int"))
    asked = found.join(twice.hint("merge"), "anchor").groupBy("key").agg(F.collect_set("place").alias("places"))
    asked = placed.filter("not copy").select("id", "tie", "key", "base").join(asked.hint("merge"), "key")
    asked = written(asked, "passage-asked")

    # Windows around them, each with the earliest place of the same words.
    same_row = lambda a, b: (a["key"] == b["key"]) & (a["tie"] == b["tie"]) & a["id"].eqNullSafe(b["id"])
    some = maybe_among(rows, "key", asked.select("key"))  # the other texts need not be shuffled
    texts = some.join(asked.hint("merge").alias("a"), same_row(some, asked)).select("a.base", "a.places", "text")
    windows = texts.mapInArrow(_windows(window), schema("w1 long, w2 int, base long, start int"))
    windows = written(windows, "passage-windows")
    where = F.col("base") + F.col("start")
    first = windows.groupBy("w1", "w2").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    # Written, so that the rows of a very common window can be split in the join.
    first = written(first.filter("first < last").drop("last"), "passage-firsts")
    gone = (
        windows.join(first.hint("merge"), ["w1", "w2"])
        .filter(where > F.col("first"))
        .groupBy("base").agg(F.collect_set("start").alias("gone"))
    )
    gone = written(placed.join(gone.hint("merge"), "base", "left").filter("copy or gone is not null"), "passage-gone")
    marked = with_mark(rows, "key", gone.select("key"), "marked")
    some = marked.filter("marked")
    some = some.join(gone.hint("merge").alias("g"), same_row(some, gone), "left").select(
        some["id"], some["text"], F.coalesce("g.copy", F.lit(False)).alias("copy"), "g.gone"
    )
    whole = marked.filter("not marked").select(
        "id", "text", F.lit(False).alias("copy"), F.lit(None).cast("array<int>").alias("gone")
    )
    marked = some.union(whole)
    kept = marked.mapInArrow(_kept(window), schema("text string, n_words long, n_removed long", id_field))
    return kept.withColumnRenamed("id", id_col)
