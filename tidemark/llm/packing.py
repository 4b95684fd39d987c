"""Packing of examples into sequences: vector bin packing by dot products."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bpe import ChunkIds, encoder, ranks_of_json, read_ranks
from tidemark.llm.common import bounded_batches, text_of

# Sequences of one task are numbered from its partition times this on.
SEQUENCES_PER_TASK = 1 << 40


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold, in three dimensions at once."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss_tokens], np.int64)


class DotProductPacker:
    """Fills one sequence at a time from a pool of waiting pieces.

    The next piece is the one, among those that fit in every dimension, whose
    demand has the largest dot product with what the sequence has left, both as
    shares of the limits. If none fits, the best piece is cut at what is left,
    so a sequence ends full in one of its dimensions. The pool has a fixed
    size, so the memory does not grow with the stream.

    A piece is (key, ids, start, end, first_loss): ids from ``start`` to ``end``
    of an example, of which those from ``first_loss`` on bear loss.
    """

    def __init__(self, limits: Limits, pool: int = 256, sequence: int = 0):
        if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
            raise ValueError("each limit must allow at least one")
        self.limits, self.size, self.sequence = limits, pool, sequence
        self.pieces: list[list] = []
        self.demand = np.zeros((pool + 1, 3), np.int64)

    @staticmethod
    def _loss(start: int, end: int, first_loss: int) -> int:
        return max(0, end - max(start, first_loss))

    def _longest(self, start: int, end: int, first_loss: int, tokens: int, loss: int) -> int:
        """How many ids from ``start`` fit into so many tokens and loss-bearing tokens."""
        length = min(end - start, tokens)
        return min(length, max(0, first_loss - start) + loss)

    def _placed(self, piece: list, length: int, offset: int) -> tuple:
        key, ids, start, _, first_loss = piece
        end = start + length
        crc = zlib.crc32(ids[4 * start : 4 * end])
        return (
            key, start, length, crc, len(ids) // 4, self.sequence, offset,
            self._loss(start, end, first_loss),
        )

    def add(self, key, ids: bytes, loss_tokens: int | None = None) -> Iterator[tuple]:
        """Take in an example whose last ``loss_tokens`` ids (None: all) bear loss."""
        total = len(ids) // 4
        first_loss = 0 if loss_tokens is None else total - min(total, max(0, loss_tokens))
        start = 0
        while start < total:
            length = self._longest(
                start, total, first_loss, self.limits.tokens, self.limits.loss_tokens
            )
            piece = [key, ids, start, start + length, first_loss]
            start += length
            if length == self.limits.tokens:
                yield self._placed(piece, length, 0)
                self.sequence += 1
                continue
            self._wait(piece)
            if len(self.pieces) > self.size:
                yield from self._fill(self.limits.tokens)

    def finish(self) -> Iterator[tuple]:
        """Pack what waits; the rest below one sequence goes to powers of two, unpadded."""
        while self.pieces:
            left = int(self.demand[: len(self.pieces), 0].sum())
            most = self.limits.tokens
            yield from self._fill(most if left >= most else 1 << (left.bit_length() - 1))

    def _wait(self, piece: list) -> None:
        _, _, start, end, first_loss = piece
        self.demand[len(self.pieces)] = end - start, 1, self._loss(start, end, first_loss)
        self.pieces.append(piece)

    def _take(self, i: int) -> list:
        piece, last = self.pieces[i], len(self.pieces) - 1
        self.pieces[i] = self.pieces[last]
        self.demand[i] = self.demand[last]
        self.pieces.pop()
        return piece

    def _fill(self, tokens: int) -> Iterator[tuple]:
        share = 1.0 / self.limits.vector() ** 2
        left = self.limits.vector()
        left[0] = min(left[0], tokens)
        offset = 0
        while self.pieces and left[0] > 0 and left[1] > 0:
            demand = self.demand[: len(self.pieces)]
            value = demand @ (left * share)
            fits = (demand <= left).all(axis=1)
            if fits.any():
                i = int(np.argmax(np.where(fits, value, -1.0)))
                piece = self._take(i)
                length = piece[3] - piece[2]
            else:
                i = int(np.argmax(value))
                _, _, start, end, first_loss = self.pieces[i]
                length = self._longest(start, end, first_loss, int(left[0]), int(left[2]))
                if length == 0:  # no loss-bearing token fits any more
                    break
                piece = list(self.pieces[i])
                self.pieces[i][2] = start + length
                self.demand[i] = (
                    end - start - length, 1, self._loss(start + length, end, first_loss),
                )
            row = self._placed(piece, length, offset)
            yield row
            offset += length
            left = left - np.array([length, 1, row[7]])
        self.sequence += 1


PLACED = [
    ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()),
    ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType()),
    ("loss_tokens", T.LongType()),
]


def pack_texts(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    limits: Limits = Limits(),
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
) -> DataFrame:
    """Tokenise whole texts and pack them; one row per piece.

    An example is the ids of its prompt (if ``prompt_col`` is given; these bear
    no loss), its text's ids and ``end_id``; null counts as empty. Rows: id,
    ``start`` and ``length`` of the piece among the example's ids, ``ids_crc32``,
    ``doc_tokens`` (all ids of the example), ``sequence_id``, ``offset`` in the
    sequence, ``loss_tokens`` of the piece. Every id lies in exactly one piece.

    Each task packs its own rows in one pass with a bounded pool, so nothing is
    shuffled, and a repeated task gives the same rows; sequences never cross
    tasks. Examples above the limits are cut. Repeated rows and null ids are
    packed like any other. Other columns are ignored; an empty table gives no row.
    """
    bounded_batches(docs.sparkSession)
    data = read_ranks(tokenizer_path)
    key = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, key), *(T.StructField(n, t) for n, t in PLACED)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = ChunkIds(encoder(data, pattern, ranks_of_json))
        closing = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        packer = DotProductPacker(limits, sequence=task * SEQUENCES_PER_TASK)
        arrow_key = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], arrow_key), *(pa.array(c, pa.int64()) for c in columns[1:])],
                schema.names,
            )

        for batch in batches:
            arrow_key = batch.schema.field(0).type
            rows: list[tuple] = []
            for k, text, prompt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = cache.encode(text) + closing
                loss = None if prompt is None else len(own) // 4
                rows.extend(packer.add(k, (cache.encode(prompt) if prompt else b"") + own, loss))
            if rows:
                yield out(rows)
        if rows := list(packer.finish()):
            yield out(rows)

    prompt = F.lit(None).cast("string") if prompt_col is None else text_of(prompt_col)
    examples = docs.select(F.col(id_col), text_of(text_col).alias("_text"), prompt.alias("_prompt"))
    return examples.mapInArrow(packed, schema)
