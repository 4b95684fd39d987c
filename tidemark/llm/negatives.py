"""Hard negatives: one-bit codes of rotated vectors bound every score, what survives is scored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.session import written

BLOCK_ROWS = 8192
BLOCK_ANCHORS = 512
# Bits to which a rotated query is rounded before its inner products with codes are counted.
QUERY_BITS = 6
# Anchors whose intervals are held at once.
CHUNK = 32
# Of the product of both lengths: what rounding of doubles may add to a bound.
SLACK = 1e-9


def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(20_111 + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def packed_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones as words of 64 bits."""
    wide = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), np.uint8)
    wide[..., : bits.shape[-1]] = bits
    return np.packbits(wide, axis=-1, bitorder="little").view("<u8")


def codes(ints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signs of the rotated vectors as bits, each vector's alignment with its code, and the rest.

    A code stands for the unit vector with those signs. A vector is ``align``
    times that, and a residual of length ``rest`` at a right angle to it.
    """
    turned = ints @ rotation(ints.shape[1]).T
    align = np.abs(turned).sum(axis=1) / math.sqrt(ints.shape[1])
    rest = np.sqrt(np.maximum((ints * ints).sum(axis=1) - align**2, 0))
    return packed_bits(turned > 0), align, rest


class Queries:
    """Rotated and rounded vectors, whose inner products with codes are bit counts."""

    def __init__(self, ints: np.ndarray):
        self.ints, self.dim = ints, ints.shape[1]
        turned = ints @ rotation(self.dim).T
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-12) / (2**QUERY_BITS - 1)
        rounded = np.rint((turned - self.low[:, None]) / self.step[:, None])
        shown = self.low[:, None] + self.step[:, None] * rounded
        self.off = np.linalg.norm(turned - shown, axis=1)
        self.total = shown.sum(axis=1)
        self.norm = np.linalg.norm(ints, axis=1)
        self.planes = [packed_bits((rounded.astype(np.int64) >> j) & 1) for j in range(QUERY_BITS)]

    def bounds(self, part: slice, bits: np.ndarray, align: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the inner product of each query with each vector.

        The query's share along the code is known from bit counts, up to what
        rounding took (``off``). Along the residual the product is at most the
        residual's length times that of the query's share across the code, by
        Cauchy and Schwarz. Both hold for every vector, so no score lies outside.
        """
        ones = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        held = np.zeros((len(self.low[part]), len(bits)), np.int64)
        for j, plane in enumerate(self.planes):
            for w in range(bits.shape[1]):
                held += np.bitwise_count(plane[part, None, w] & bits[None, :, w]).astype(np.int64) << j
        along = self.low[part, None] * ones + self.step[part, None] * held
        along = (2 * along - self.total[part, None]) / math.sqrt(self.dim)
        least = np.maximum(np.abs(along) - self.off[part, None], 0)
        across = np.sqrt(np.maximum(self.norm[part, None] ** 2 - least**2, 0))
        length = np.sqrt(align**2 + rest**2)
        half = align * self.off[part, None] + rest * across + SLACK * (1 + self.norm[part, None] * length)
        return align * along - half, align * along + half


def exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole-number inner products; doubles where these hold them without loss."""
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(query).max(initial=0)) * len(query)
    if most < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)


class Block:
    """The vectors of one packed row, in memory."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.uid = row["uid"] + np.arange(len(row["labels"]))
        self.unnamed = np.array([i is None for i in row["ids"]])
        self.ids = np.array([0 if i is None else i for i in row["ids"]], np.int64)
        self.labels = np.array(row["labels"], np.int64)
        self.ints = np.frombuffer(row["ints"], "<i4").reshape(-1, dim)
        self.bits = np.frombuffer(row["bits"], "<u8").reshape(len(self.labels), -1)
        self.align, self.rest = np.frombuffer(row["align"], "<f8"), np.frombuffer(row["rest"], "<f8")

    def name(self, i: int) -> int | None:
        return None if self.unnamed[i] else int(self.ids[i])

    def best(self, at: np.ndarray, scores: np.ndarray, most: int) -> list[tuple[int, int]]:
        """(number, score) of the first by score, then id (null last)."""
        if len(at) > most:
            near = scores >= np.partition(scores, -most)[-most]
            at, scores = at[near], scores[near]
        order = np.lexsort((self.uid[at], self.ids[at], self.unnamed[at], -scores))[:most]
        return [(int(at[i]), int(scores[i])) for i in order]


_BLOCK = (
    "uid long, dim int, ids array<long>, labels array<long>, ints binary, bits binary, align binary, rest binary"
)


def _packed(scale: int):
    """Vectors of a task in blocks of one length each, with codes and alignments."""

    def block(rows: list, dim: int, uid: int) -> pa.RecordBatch:
        ids, labels, ints = zip(*rows)
        ints = np.stack(ints)
        bits, align, rest = codes(ints)
        values = [uid, dim, list(ids), list(labels), ints.astype("<i4").tobytes(), bits.tobytes(), align.tobytes(), rest.tobytes()]
        names = ["uid", "dim", "ids", "labels", "ints", "bits", "align", "rest"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        open_blocks: dict[int, list] = {}
        for batch in batches:
            vectors = batch.column("vector")
            flat, ends = np.asarray(vectors.flatten()), np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            for i, (key, label) in enumerate(zip(batch.column("id").to_pylist(), batch.column("label").to_pylist())):
                x = flat[(ends[i - 1] if i else 0) : ends[i]]
                whole = np.floor(x * float(scale))
                # Beyond this a score need not fit a long.
                if not len(x) or not (np.abs(whole) < min(2**31, math.isqrt(2**62 // len(x)))).all():
                    continue
                rows = open_blocks.setdefault(len(x), [])
                rows.append((key, label, whole))
                if len(rows) == BLOCK_ROWS:
                    yield block(open_blocks.pop(len(x)), len(x), uid)
                    uid += BLOCK_ROWS
        for dim, rows in open_blocks.items():
            yield block(rows, dim, uid)
            uid += len(rows)

    return pack


def _met(pairs: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Queries, Block]]:
    """Each block of anchors with each block of vectors it meets."""
    for batch in pairs:
        for row in batch.to_pylist():
            anchors = row["anchors"]
            ints = np.frombuffer(b"".join(a["ints"] for a in anchors), "<i4").reshape(len(anchors), -1)
            yield anchors, Queries(ints.astype(np.float64)), Block(row)


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _chunks(queries: Queries, block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Bounds of each query in turn against the block."""
    for start in range(0, len(queries.ints), CHUNK):
        low, high = queries.bounds(slice(start, start + CHUNK), block.bits, block.align, block.rest)
        for i in range(len(low)):
            yield start + i, low[i], high[i]


_POSITIVES = "a_uid long, anchor_id long, p_uid long, positive_id long, positive_score long"


def _positives(most: int):
    names = ["a_uid", "anchor_id", "p_uid", "positive_id", "positive_score"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def positives(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, queries, block in _met(pairs):
            found = []
            for i, low, high in _chunks(queries, block):
                anchor = anchors[i]
                at = np.flatnonzero((block.labels == anchor["label"]) & (block.uid != anchor["uid"]))
                if len(at) > most:
                    at = at[high[at] >= np.partition(low[at], -most)[-most]]
                scores = exact(block.ints[at], queries.ints[i])
                for j, score in block.best(at, scores, most):
                    found.append((anchor["uid"], anchor["id"], int(block.uid[j]), block.name(j), score))
            yield _rows(found, schema)

    return positives


_NEGATIVES = _POSITIVES + ", n_uid long, negative_id long, negative_score long"


def _negatives(most: int, from_percent: int, to_percent: int):
    names = [f.split()[0] for f in _NEGATIVES.split(", ")]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def negatives(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors, queries, block in _met(pairs):
            found = []
            for i, low, high in _chunks(queries, block):
                anchor = anchors[i]
                other = np.flatnonzero(block.labels != anchor["label"])
                low, high = 100 * low[other], 100 * high[other]
                for p in anchor["positives"]:
                    least, top = from_percent * p["score"], to_percent * p["score"]
                    if least > top:
                        continue
                    # Enough rows surely within the band: what is surely below them is not asked.
                    sure = low[(low >= least) & (high <= top)]
                    bar = np.partition(sure, -most)[-most] if len(sure) > most else least
                    at = other[(high >= max(bar, least)) & (low <= top)]
                    scores = exact(block.ints[at], queries.ints[i])
                    within = (100 * scores >= least) & (100 * scores <= top)
                    for j, score in block.best(at[within], scores[within], most):
                        found.append(
                            (anchor["uid"], anchor["id"], p["uid"], p["id"], p["score"], int(block.uid[j]), block.name(j), score)
                        )
            yield _rows(found, schema)

    return negatives


def _anchor_rows(blocks: DataFrame, is_anchor: Column) -> DataFrame:
    """The anchors among the vectors of the blocks: uid, id, label, dim, ints."""
    width = 4 * F.col("dim")
    each = blocks.select(
        "uid", "dim", "ints", F.posexplode(F.arrays_zip("ids", "labels")).alias("i", "row")
    )
    named = each.select(
        (F.col("uid") + F.col("i")).alias("uid"), F.col("row.ids").alias("id"), F.col("row.labels").alias("label"),
        "dim", F.substring("ints", F.col("i") * width + 1, width).alias("ints"),
    )
    return named.filter(is_anchor)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    from_percent: int = 50,
    to_percent: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Per anchor, positive and rank: the rows of other labels that come nearest below the positive.

    Components become floor(scale * x); scores are their whole-number inner
    products with the anchor's. ``is_anchor`` is a condition on ``id``. An
    anchor's positives are the first ``positives`` other rows of its label by
    score, ties by smaller id; the negatives of each are the first ``negatives``
    rows of other labels with ``from_percent`` to ``to_percent`` of its score.
    Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    Vectors are packed into blocks where they lie, with the sign bits of their
    rotation and how well these align with the vector. Blocks of anchors meet
    blocks of vectors by an equal group number, into which the vectors' blocks are
    dealt; so tasks hold one block of each at a time, whatever the number of
    anchors, rows or rows a label has. In a task, bit counts give an interval for
    each score that surely holds it. Only rows whose interval reaches those of the
    best are scored, so the result is that of scoring all, and each block passes
    on its few best. An interval is wide where a code aligns badly; then more rows
    are scored, and none is lost.

    Rows with a null label, a null vector, or a null or non-finite component take
    no part, nor do empty vectors or those with components so large that a score
    might not fit a long. Vectors of different lengths are not compared. A null id
    is no anchor and comes behind other ids in ties. Repeated rows count as rows
    each; a repeated anchor gives its result as often. An anchor without positives
    gives no row. Other columns are ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taking_part = rows.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()).filter(finite)
    plain = taking_part.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    blocks = written(plain.mapInArrow(_packed(scale), _BLOCK), "negative-blocks")
    n_blocks = max(blocks.count(), 1)
    blocks = blocks.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int"))
    anchors = written(_anchor_rows(blocks, is_anchor), "negative-anchors")
    n_parts = max(-(-anchors.count() // BLOCK_ANCHORS), 1)

    def met(anchors: DataFrame) -> DataFrame:
        """Blocks of anchors beside the blocks of all vectors."""
        part = F.pmod(F.xxhash64("uid"), F.lit(n_parts))
        row = F.struct(*anchors.drop("dim").columns)
        packs = anchors.groupBy("dim", part.alias("part")).agg(F.collect_list(row).alias("anchors"))
        asked = packs.select("dim", "anchors", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("group"))
        return blocks.join(asked.hint("merge"), ["dim", "group"]).drop("group")

    def first(found: DataFrame, of: list[str], score: str, key: str, uid: str, most: int) -> DataFrame:
        order = W.partitionBy(*of).orderBy(F.desc(score), F.asc_nulls_last(key), uid)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    near = met(anchors).mapInArrow(_positives(positives), _POSITIVES)
    near = first(near, ["a_uid"], "positive_score", "positive_id", "p_uid", positives)
    bands = near.groupBy("a_uid").agg(
        F.collect_list(
            F.struct(F.col("p_uid").alias("uid"), F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
        ).alias("positives")
    )
    banded = written(anchors.join(bands.withColumnRenamed("a_uid", "uid").hint("merge"), "uid"), "negative-bands")
    found = met(banded).mapInArrow(_negatives(negatives, from_percent, to_percent), _NEGATIVES)
    found = first(found, ["a_uid", "p_uid"], "negative_score", "negative_id", "n_uid", negatives)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
