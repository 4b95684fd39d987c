"""Byte-level BPE encoding and decoding by a local rank file."""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import REMEMBERED, bounded_batches, text_of, texts_in

# Texts longer than this are encoded piece by piece.
PIECE_CHARS = 100_000
# A run of spaces and line feeds after something that is no white space at all:
# no token of the split pattern reaches across its start.
_SAFE_CUT = re.compile(r"(?<=\S)[ \n]")

_encoders: dict[tuple[str, str], tiktoken.Encoding] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Ranks of a rank file: one base64 token and its rank a line."""
    lines = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def ranks_of_json(data: bytes) -> dict[bytes, int]:
    """Ranks of a byte-level BPE tokenizer file, whose ids follow its merges."""
    vocabulary = json.loads(data)["model"]["vocab"]
    special = {t["content"] for t in json.loads(data)["added_tokens"]}
    # The printable stand-ins of that format: visible bytes for themselves, the rest from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in special}


def encoder(data: bytes, pattern: str, ranks=ranks_of) -> tiktoken.Encoding:
    """One encoder per worker process and file."""
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _encoders:
        _encoders[key] = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks(data), special_tokens={}
        )
    return _encoders[key]


def pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """Cut before white space that follows something else, beyond ``most`` characters.

    The pattern's tokens start with at most one space and hold no white space
    behind another character, so the tokens of the pieces are those of the text.
    A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > most:
        cut = _SAFE_CUT.search(text, start + most)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, tokens: tiktoken.Encoding, most: int = PIECE_CHARS) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return b"".join(
        np.asarray(tokens.encode_ordinary(piece), "<u4").tobytes() for piece in pieces(text, most)
    )


class ChunkIds(dict):
    """Ids of words with the space before them, remembered by the worker.

    A text is cut before its spaces. That is no cut inside a token as long as its
    only white space is single spaces and line feeds, with no space between two
    line feeds; other texts are encoded whole. Two generations bound the memory:
    what isn't used again while ``REMEMBERED`` words come in is forgotten.
    """

    # All white space but space and line feed, more than the pattern knows.
    OTHER_SPACE = (
        "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
        "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
    )
    LONGEST = 40

    def __init__(self, tokens: tiktoken.Encoding):
        super().__init__()
        self.tokens = tokens
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if len(word) > self.LONGEST:
                return encode(f" {word}", self.tokens)
            ids = array("I", self.tokens.encode_ordinary(f" {word}")).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if "  " in text or "\n \n" in text or any(c in text for c in self.OTHER_SPACE):
            return encode(text, self.tokens)
        first, *words = text.split(" ")
        return encode(first, self.tokens) + b"".join(map(self.__getitem__, words))


def decode(ids: bytes, tokens: tiktoken.Encoding) -> bytes:
    """The raw bytes, also of ids that end within a character."""
    return tokens.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def bpe_ids(text: Column, path: str, pattern: str) -> Column:
    """Ids of each text as little-endian unsigned 32-bit numbers (binary)."""
    data = read_ranks(path)

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = encoder(data, pattern)
        for batch in batches:
            yield pa.array([encode(t, tokens) for t in texts_in(batch)], pa.binary())

    return encoded(text)


def bpe_text(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ids (as from ``bpe_ids``) stand for; null for null."""
    data = read_ranks(path)

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = encoder(data, pattern)
        for batch in batches:
            yield pa.array(
                [None if x is None else decode(x, tokens) for x in batch.to_pylist()], pa.binary()
            )

    return decoded(ids)


def bpe_round_trip(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``ids`` (binary, 4 bytes each) and ``decoded`` (binary).

    Null counts as empty and has no ids. Rows are independent of each other:
    repeated rows and null ids give rows alike. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    encoded = docs.select(
        F.col(id_col).alias(id_col), bpe_ids(text_of(text_col), path, pattern).alias("ids")
    )
    return encoded.withColumn("decoded", bpe_text(F.col("ids"), path, pattern))
