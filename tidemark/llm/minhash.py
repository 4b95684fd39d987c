"""MinHash near-dedup: fast similarity sketches, banding, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ascii_words, bounded_batches, mix, seeds, text_of, word_hashes
from tidemark.llm.native import maybe_among
from tidemark.session import written

BAND_ROWS = 6
# A pair at the threshold shares no band with this probability.
MISSED = 1e-5
# Up to so many members all pairs of a bucket may be looked at; larger ones take pivots in turn.
SMALL_BUCKET = 64
PIVOTS = 64
# Later rounds take so many; what is still apart by then meets few that it could be linked to.
MORE_PIVOTS = 1024
# Bits of a set's parity bitmap, in words of 64.
BITMAP_WORDS = 8


def bands_for(percent: int, rows: int = BAND_ROWS, missed: float = MISSED) -> int:
    """Bands of so many rows that a pair at the threshold is missed that rarely."""
    return math.ceil(math.log(missed) / math.log1p(-((percent / 100) ** rows)))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of all texts one after the other, and how many each has.

    Words are lower-cased in A-Z and lie between ASCII white space. A text with
    fewer words than a shingle has one shingle of all of them; one without words none.
    """
    flat, counts = ascii_words(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    hashed = word_hashes(flat)
    n = len(counts)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(n), counts)
    length = np.minimum(counts, words)
    # A shingle starts at every word that has enough words behind it, or at the first of a short text.
    place = np.arange(len(hashed)) - np.repeat(ends - counts, counts)
    start = np.flatnonzero(place + length[owner] <= counts[owner])
    owner = owner[start]
    size = length[owner]
    out = mix(size.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    for j in range(words):
        more = np.flatnonzero(size > j)
        out[more] = mix(out[more] * np.uint64(0x2545F4914F6CDD1D) ^ hashed[start[more] + j])
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[first], np.bincount(owner[first], minlength=n).astype(np.int64)


class FastSimilaritySketch:
    """``size`` bins, each with the same chance of agreeing as the Jaccard similarity.

    In rounds 0 to size - 1 every element goes to a hashed bin with a hashed
    value; in round size + i all elements go to bin i. A bin keeps the smallest
    (round, value), so what an earlier round put there stays, every bin is full
    after 2 * size rounds at the latest, and about size log size / n rounds do.
    The first size rounds are like throwing balls at random, which gives the
    number of equal bins the concentration of independent trials.
    """

    def __init__(self, size: int):
        self.size = size
        self.seeds = seeds(2 * size, start=1_000)

    def of(self, elements: np.ndarray) -> np.ndarray:
        t, n = self.size, len(elements)
        bins = np.full(t, np.iinfo(np.uint64).max, np.uint64)
        empty = np.iinfo(np.uint64).max
        at = 0
        # Rounds that fill all bins with high probability are taken at once; earlier ones win anyway.
        step = max(1, min(t, math.ceil(t * (math.log(t) + 2) / n), 1 + 200_000 // n))
        while at < t and (bins == empty).any():
            rounds = np.arange(at, min(t, at + step))
            h = mix(elements[None, :] ^ self.seeds[rounds][:, None])
            place = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(t)) >> np.uint64(32)
            value = (rounds.astype(np.uint64)[:, None] << np.uint64(48)) | (h >> np.uint64(16))
            np.minimum.at(bins, place.ravel().astype(np.int64), value.ravel())
            at += step
        for i in np.flatnonzero(bins == empty):
            h = mix(elements ^ self.seeds[t + i])
            bins[i] = (np.uint64(t + i) << np.uint64(48)) | (h.min() >> np.uint64(16))
        return bins


def band_keys(sketch: np.ndarray, rows: int, band_seeds: np.ndarray) -> np.ndarray:
    """One 64-bit key a band: its number and its rows."""
    bands = sketch.reshape(-1, rows)
    out = band_seeds[: len(bands)].copy()
    for j in range(rows):
        out = mix(out * np.uint64(0x2545F4914F6CDD1D) ^ bands[:, j])
    return out


def sketched(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, ``n`` (set size), ``set_a`` and ``set_b`` (hash of the set), ``bands``.

    A set has bands only if another set of its size or more can reach the
    threshold: of n elements, a different set has at most n / (n + 1) in common.
    """
    bounded_batches(docs.sparkSession)
    rows, bands = BAND_ROWS, bands_for(percent)
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, keys = FastSimilaritySketch(rows * bands), seeds(bands, start=77)
        for batch in batches:
            values, counts = shingle_sets(batch.column(1), words)
            a, b = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
            own, at = [], 0
            for i, n in enumerate(counts):
                elements = values[at : at + n]
                at += n
                a[i] = mix(elements ^ np.uint64(3)).sum(dtype=np.uint64)
                b[i] = np.bitwise_xor.reduce(mix(elements ^ np.uint64(5))) if n else 0
                far = 100 * n < percent * (n + 1)
                own.append(None if far else band_keys(sketch.of(elements), rows, keys).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(counts, pa.int64()), pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)), pa.array(own, pa.list_(pa.int64())),
                ],
                schema.names,
            )

    return docs.select(F.col(id_col), text_of(text_col).alias("_text")).mapInArrow(sketches, schema)


def parity_bitmaps(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Per set, whether an odd number of its elements hash to each bit.

    Two bitmaps differ in no more bits than their sets differ in elements.
    """
    width = 64 * BITMAP_WORDS
    owner = np.repeat(np.arange(len(counts)), counts)
    place = ((mix(values ^ np.uint64(9)) >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)
    odd = np.bincount(owner * width + place, minlength=len(counts) * width) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")
    cuts = np.arange(0, len(words) + 1, BITMAP_WORDS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(words))


def bits_apart(a: str, b: str) -> Column:
    """In how many bits two bitmaps differ."""
    differing = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITMAP_WORDS)]
    return reduce(Column.__add__, differing)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """The whole shingle sets (``node``, ``n``, ``shingles``, ``bits``) of the wanted nodes, each of which is there once."""
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("node", docs.schema[id_col].dataType), T.StructField("n", T.LongType()),
        T.StructField("shingles", longs), T.StructField("bits", longs),
    ])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, counts = shingle_sets(batch.column(1), words)
            cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(cuts, pa.array(values.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), lists, parity_bitmaps(values, counts)],
                schema.names,
            )

    texts = docs.select(F.col(id_col).alias("node"), text_of(text_col).alias("_text"))
    # Most texts need not be shuffled. An inner join, since a semi join would be done first.
    texts = maybe_among(texts, "node", wanted)
    return texts.join(wanted.hint("merge"), "node").mapInArrow(sets, schema)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    Pairs that sizes or bitmaps rule out go first; then only sets that are still
    asked for are shuffled, those of each side apart.
    """
    facts = lambda side: sets.select(
        F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")
    )
    possible = (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")) & (
        (100 + percent) * bits_apart("bits_a", "bits_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    )
    sized = pairs.join(facts("a"), "a").join(facts("b"), "b").filter(possible)
    sized = written(sized.select("a", "b", "n_a", "n_b"), "near-pairs")

    def whole(side: str) -> DataFrame:
        asked = maybe_among(sets.select("node", "shingles"), "node", sized.select(side).distinct())
        return asked.select(F.col("node").alias(side), F.col("shingles").alias(f"s_{side}"))

    found = sized.join(whole("a").hint("merge"), "a").join(whole("b").hint("merge"), "b")
    both = F.size(F.array_intersect("s_a", "s_b")).cast("long")
    return (
        found.select("a", "b", "n_a", "n_b", both.alias("both"))
        .filter(100 * F.col("both") >= percent * (F.col("n_a") + F.col("n_b") - F.col("both")))
        .select("a", "b")
        .distinct()
    )


def components(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The smallest node reachable from each node (``node``, ``label``).

    ``labels`` are those known so far. Labels go along the links and then jump
    to the label of the label, until none changes; each turn is written to
    shared storage, so lost executors cost no earlier turn. A node with very
    many links is met by grouping within tasks and by splitting skewed joins.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    while True:
        told = both.join(labels, "node").select(F.col("other").alias("node"), "label")
        least = labels.union(told).groupBy("node").agg(F.min("label").alias("label"))
        least = written(least, "near-labels")
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(
            least.join(jump, "label", "left").select(
                "node", F.coalesce("further", "label").alias("label")
            ),
            "near-labels",
        )
        changed = (
            new.join(labels.withColumnRenamed("label", "was"), "node").filter("label <> was").limit(1)
        )
        labels = new
        if changed.isEmpty():
            return labels


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of
    their sets of word shingles. ``component_id`` is the smallest id reachable
    over links, ``kept`` whether it is the row's own.

    Rows with the same set are one node, named by its smallest id. Nodes that
    share a band key are candidates. Each is first compared with the hub of its
    bucket: the node that meets most others in all its buckets, as an original
    does among its edited copies. Then, as long as a bucket holds several
    components, its nodes outside the largest one are compared with the nodes of
    other components: all at once in small buckets, some at a time in large
    ones. Left out are only pairs that sizes, shingles no other node has or the
    number of bits their sets' bitmaps differ in rule out, each a bound that no
    linked pair exceeds. So no link inside a bucket is lost that would join two components, and
    the pairs looked at grow with the bucket, not with its square, unless its
    nodes really could differ by so little. Links are confirmed on full sets.

    A text without words has an empty set and no links. Rows with a null id are
    linked with nothing (null ``component_id``, kept). Rows that share an id are
    one node. Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(sketched(docs, words, percent, id_col, text_col), "near-sketches")
    real = rows.filter((F.col("n") > 0) & F.col("id").isNotNull())
    same = ["set_a", "set_b", "n"]
    groups = written(real.groupBy(*same).agg(F.min("id").alias("node")), "near-groups")
    named = written(
        real.join(groups, same).select(
            "id", "n", "node", F.when(F.col("id") == F.col("node"), F.col("bands")).alias("bands")
        ),
        "near-named",
    )
    banded = named.filter("bands is not null").select("node", "n", F.explode("bands").alias("key"))
    buckets = written(
        banded.groupBy("key")
        .agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("first"), F.max("node").alias("last"))
        .filter("first < last")
        .select("key", "size"),
        "near-buckets",
    )
    members = written(banded.join(buckets, "key"), "near-members")
    labels = linked(docs, members, words, percent, id_col, text_col)
    found = named.join(labels, "node", "left").select(
        "id", "n", F.coalesce("label", "node").alias("component_id")
    )
    alone = rows.filter((F.col("n") == 0) | F.col("id").isNull()).select(
        "id", "n", F.col("id").alias("component_id")
    )
    return found.union(alone).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def own_shingles(sets: DataFrame) -> DataFrame:
    """How many shingles of each node no other of these nodes has (``node``, ``own``)."""
    once = (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("node").alias("node"), F.max("node").alias("last"))
        .filter("node = last")
    )
    return once.groupBy("node").agg(F.count(F.lit(1)).alias("own"))


def linked(
    docs: DataFrame, members: DataFrame, words: int, percent: int, id_col: str, text_col: str
) -> DataFrame:
    """Labels of the nodes that share a bucket (key, node, n, size) with another."""
    nodes = members.select("node").distinct()
    sets = written(full_sets(docs, nodes, words, id_col, text_col), "near-sets")
    labels = written(nodes.select("node", F.col("node").alias("label")), "near-labels")
    met = written(
        members.groupBy("node").agg(F.sum("size").alias("met"), F.collect_set("key").alias("keys")), "near-met"
    )
    hubs = members.join(met.drop("keys"), "node").groupBy("key").agg(
        F.max_by(F.struct("node", "n", "met"), F.struct("met", "node")).alias("hub")
    )
    hubs = written(hubs, "near-hubs")

    def compared(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return written(verified(ordered.distinct(), sets, percent), "near-links")

    # Each node with the best hub of its buckets; then with the others that are still apart from it.
    sized = 100 * F.least("n", "hub.n") >= percent * F.greatest("n", "hub.n")
    to_hubs = written(members.join(hubs, "key").filter((F.col("node") != F.col("hub.node")) & sized), "near-to-hubs")
    best = to_hubs.groupBy("node").agg(F.max_by("hub.node", F.struct("hub.met", "hub.node")).alias("hub"))
    links = compared(best.select(F.col("hub").alias("a"), F.col("node").alias("b")))
    labels = components(links, labels)
    its = labels.select(F.col("node").alias("hub_node"), F.col("label").alias("hub_label"))
    rest = to_hubs.select("node", F.col("hub.node").alias("hub_node")).distinct()
    rest = rest.join(labels, "node").join(its, "hub_node").filter("label <> hub_label")
    more = compared(rest.select(F.col("hub_node").alias("a"), F.col("node").alias("b")))
    if not more.isEmpty():
        links = written(links.union(more), "near-links")
        labels = components(links, labels)
    done = hubs.select("key", "hub.node")  # compared with all others of the bucket
    work = written(members.join(labels, "node"), "near-work")
    mixed = written(mixed_buckets(work), "near-mixed")
    work = work.join(mixed.select("key"), "key", "left_semi")
    # Only nodes of mixed buckets can still find a partner, and only among themselves.
    apart = written(work.select("node").distinct(), "near-apart")
    own = own_shingles(sets.join(apart, "node", "left_semi"))
    facts = apart.join(own, "node", "left").join(met, "node").join(sets.select("node", "bits"), "node")
    facts = written(facts.select("node", "keys", "bits", F.coalesce("own", F.lit(0)).alias("own")), "near-own")
    # At most ``known`` shingles of a node are in any other; too few of them rule a node out.
    work = work.join(facts, "node").withColumn("known", F.col("n") - F.col("own")).drop("own")
    enough = lambda known, n: (100 + percent) * known >= percent * n
    least_partner = F.ceil(F.col("n") * percent / 100)
    work = written(work.filter(enough(F.col("known"), F.col("n") + least_partner)), "near-work")
    turn = 0
    while True:
        mixed = mixed_buckets(work).select("key", "main", "least")
        smallest = F.greatest("least", least_partner)
        open_nodes = (
            work.join(mixed.withColumnRenamed("key", "at"), (F.col("key") == F.col("at")) & (F.col("label") != F.col("main")))
            .filter(enough(F.col("known"), F.col("n") + smallest))
            .join(done, ["key", "node"], "left_anti")
        )
        salt = F.when(F.col("size") <= SMALL_BUCKET, F.xxhash64("node")).otherwise(
            F.pmod(F.xxhash64("node"), F.lit(MORE_PIVOTS if turn else PIVOTS))
        )
        pivots = open_nodes.groupBy("key", salt.alias("salt")).agg(
            F.min_by(F.struct("node", "label", "n", "known", "keys", "bits"), "node").alias("p")
        )
        pivots = written(pivots.select("key", "p"), "near-pivots")
        if pivots.isEmpty():
            return labels
        possible = (
            (F.col("label") != F.col("p.label"))
            & (100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n"))
            & enough(F.least("known", "p.known"), F.col("n") + F.col("p.n"))
            & ((100 + percent) * bits_apart("bits", "p.bits") <= (100 - percent) * (F.col("n") + F.col("p.n")))
            # Once for all buckets that the two share.
            & (F.col("key") == F.array_min(F.array_intersect("keys", "p.keys")))
        )
        pairs = work.join(pivots.withColumnRenamed("key", "at"), (F.col("key") == F.col("at")) & possible)
        more = compared(pairs.select(F.col("node").alias("a"), F.col("p.node").alias("b")))
        done = written(done.union(pivots.select("key", F.col("p.node").alias("node"))), "near-done")
        if not more.isEmpty():
            links = written(links.union(more), "near-links")
            labels = components(links, labels)
        # In small buckets all nodes have had their turn.
        turn += 1
        work = work.filter(F.col("size") > SMALL_BUCKET).drop("label").join(labels, "node")
        work = written(work, "near-work")


def mixed_buckets(work: DataFrame) -> DataFrame:
    """Buckets (key) of several components: the largest (main) and the size of the smallest set (least)."""
    sizes = work.groupBy("key", "label").agg(F.count(F.lit(1)).alias("times"), F.min("n").alias("least"))
    found = sizes.groupBy("key").agg(
        F.max_by("label", F.struct("times", "label")).alias("main"),
        F.count(F.lit(1)).alias("labels"),
        F.min("least").alias("least"),
    )
    return found.filter("labels > 1").drop("labels")
