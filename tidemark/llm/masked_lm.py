"""Masked pseudo-likelihood of documents by a small bidirectional window network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_words, bounded_batches, sums_by, text_of, word_hashes
from tidemark.session import written

CLASSES = 32  # a token is a class and a member of it: two small softmaxes in place of a large one
TOKENS = CLASSES * CLASSES
RARE = 256  # numbers 1 to RARE stand for the less frequent words, by hash
KNOWN = 131_072  # tasks look the counts of so many words up by themselves, those of all others are joined
WINDOW = 2
WIDTH = 24
SHARES = 2  # rounds of training; each takes its share of all documents
STEP_TOKENS = 4096
BLOCK_TOKENS = 32_768
_OFFSETS = (-2, -1, 1, 2)


def rare_numbers(hashes: np.ndarray) -> np.ndarray:
    return (np.uint64(1) + hashes % np.uint64(RARE)).astype(np.int64)


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words by themselves, all others by hash; 0 is outside the text.

    Words are known by a 64-bit hash of all their bytes.
    """

    frequent: np.ndarray  # hashes of the frequent words, in order
    spread: np.ndarray  # log of how often the words behind each hashed number occur, and one more; else 0
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # hashes in order
    logs: np.ndarray = field(default_factory=lambda: np.zeros(0))  # log of how often each of these occurs

    def coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens and hashes of all texts one after the other, and how many each text has."""
        words, counts = ascii_words(texts)
        hashes = word_hashes(words)
        tokens = rare_numbers(hashes)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            known = self.frequent[at] == hashes
            tokens[known] = RARE + 1 + at[known]
        return tokens, hashes, counts

    def numbers(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        tokens, _, counts = self.coded(texts)
        return tokens, counts

    def logs_of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log of the count of each word, 0 if not known here; and which are known."""
        if not len(self.known):
            return np.zeros(len(hashes)), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        found = self.known[at] == hashes
        return np.where(found, self.logs[at], 0.0), found


@dataclass(frozen=True)
class Network:
    """p(token | two tokens to each side) = p(class | hidden) p(member | class, hidden)."""

    embed: np.ndarray  # [tokens, width]
    reach: np.ndarray  # [offsets, width]: how each side position counts
    hidden: np.ndarray  # [width]
    to_class: np.ndarray  # [width + 1, classes], the last row is the bias
    to_member: np.ndarray  # [classes, width + 1, members]

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        draw = lambda *shape: random.normal(0, 0.3, shape).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        return Network(
            draw(TOKENS, WIDTH), np.ones((len(_OFFSETS), WIDTH), np.float32) / 2, zero(WIDTH),
            zero(WIDTH + 1, CLASSES), zero(CLASSES, WIDTH + 1, CLASSES),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.reach, self.hidden, self.to_class, self.to_member]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def with_flat(self, values: np.ndarray) -> Network:
        out, at = [], 0
        for a in self.arrays():
            out.append(values[at : at + a.size].reshape(a.shape).astype(np.float32))
            at += a.size
        return Network(*out)

    def states(self, tokens: np.ndarray) -> np.ndarray:
        """Hidden states of the tokens ``WINDOW`` off the ends."""
        embedded, n = self.embed[tokens], len(tokens) - 2 * WINDOW
        total = np.repeat(self.hidden[None], n, 0)
        for weight, o in zip(self.reach, _OFFSETS, strict=True):
            total += weight * embedded[WINDOW + o : WINDOW + o + n]
        return np.tanh(total, out=total)

    def log_probs(self, tokens: np.ndarray) -> np.ndarray:
        """Of each token ``WINDOW`` off the ends, given the tokens to both sides."""
        inner = tokens[WINDOW : len(tokens) - WINDOW]
        h = self.states(tokens)
        group, member = inner // CLASSES, inner % CLASSES
        logits = h @ self.to_class[:-1] + self.to_class[-1]
        out = logits[np.arange(len(inner)), group] - _log_sum(logits)
        for c, at in _by_class(group):
            logits = h[at] @ self.to_member[c, :-1] + self.to_member[c, -1]
            out[at] += logits[np.arange(len(at)), member[at]] - _log_sum(logits)
        return out

    def gradients(self, stream: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Of the mean log-probability of the tokens at these places of the stream."""
        n = len(at)
        around = stream[at[:, None] + np.array(_OFFSETS)]
        embedded = self.embed[around]
        h = np.tanh(np.einsum("nod,od->nd", embedded, self.reach) + self.hidden)
        group, member = stream[at] // CLASSES, stream[at] % CLASSES
        slope = -_softmax(h @ self.to_class[:-1] + self.to_class[-1])
        slope[np.arange(n), group] += 1
        slope /= n
        g_class = np.concatenate([h.T @ slope, slope.sum(0)[None]])
        back = slope @ self.to_class[:-1].T
        g_member = np.zeros_like(self.to_member)
        for c, own in _by_class(group):
            hc = h[own]
            s = -_softmax(hc @ self.to_member[c, :-1] + self.to_member[c, -1])
            s[np.arange(len(own)), member[own]] += 1
            s /= n
            g_member[c, :-1], g_member[c, -1] = hc.T @ s, s.sum(0)
            back[own] += s @ self.to_member[c, :-1].T
        back *= 1 - h * h
        g_reach = np.einsum("nod,nd->od", embedded, back)
        by_token = (back[:, None, :] * self.reach).reshape(-1, WIDTH)
        flat = around.ravel()
        order = np.argsort(flat.astype(np.int16), kind="stable")
        cuts = np.flatnonzero(np.diff(flat[order], prepend=-1))
        g_embed = np.zeros_like(self.embed)
        g_embed[flat[order][cuts]] = np.add.reduceat(by_token[order], cuts, axis=0)
        return [g_embed, g_reach, back.sum(0), g_class, g_member]


_ONES = np.ones(CLASSES, np.float32)


def _log_sum(logits: np.ndarray) -> np.ndarray:
    # Hidden values are within 1 and weights stay small: far from what a float32 exponential holds.
    return np.log(np.exp(np.minimum(logits, 80)) @ _ONES)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(np.minimum(logits, 80))
    return e / (e @ _ONES)[:, None]


def _by_class(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(group.astype(np.int8), kind="stable")
    sizes = np.bincount(group, minlength=CLASSES)
    at = 0
    for c, size in enumerate(sizes):
        if size:
            yield c, order[at : at + size]
        at += size


def framed(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One stream of all texts, each with ``WINDOW`` zeros behind it and some before the first.

    Also the place of every token in the stream without its two outer windows.
    """
    place = np.arange(len(tokens)) + WINDOW * np.repeat(np.arange(len(counts)), counts)
    stream = np.zeros(WINDOW + len(tokens) + WINDOW * max(1, len(counts)), np.int64)
    stream[WINDOW + place] = tokens
    return stream, place


class Trainer:
    """Adaptive gradient steps over a stream of texts; every place of every text is predicted once."""

    def __init__(self, network: Network, rate: float = 0.1):
        self.network, self.rate, self.tokens = network, rate, 0
        self.seen = [np.full_like(a, 1e-6) for a in network.arrays()]

    def take(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        stream, place = framed(tokens, counts)
        self.tokens += len(tokens)
        place = place + WINDOW
        for at in range(0, len(place), STEP_TOKENS):
            grads = self.network.gradients(stream, place[at : at + STEP_TOKENS])
            new = []
            for a, s, g in zip(self.network.arrays(), self.seen, grads, strict=True):
                s += g * g
                new.append(a + self.rate * g / np.sqrt(s))
            self.network = Network(*new)


@dataclass(frozen=True)
class LanguageModel:
    vocabulary: Vocabulary
    network: Network
    counts: DataFrame | None = None  # ``hash`` and ``n`` of all words of the corpus

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each text and the sum of their conditional log-probabilities.

        Hashed words count as seen once here; ``looked_up`` adds what they occur.
        """
        tokens, counts = self.vocabulary.numbers(texts)
        return counts, self._sums(tokens, counts)

    def looked_up(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores with the counts of the words known here.

        Also the hashes of the other hashed words of all texts, and how many each has.
        """
        tokens, hashes, counts = self.vocabulary.coded(texts)
        hashed = tokens <= RARE
        hashes, text = hashes[hashed], np.repeat(np.arange(len(counts)), counts)[hashed]
        logs, found = self.vocabulary.logs_of(hashes)
        total = self._sums(tokens, counts) + np.bincount(text, logs, len(counts))
        return counts, total, hashes[~found], np.bincount(text[~found], minlength=len(counts))

    def _sums(self, tokens: np.ndarray, counts: np.ndarray) -> np.ndarray:
        stream, place = framed(tokens, counts)
        logs = np.zeros(len(stream) - 2 * WINDOW, np.float32)
        for at in range(0, len(logs), BLOCK_TOKENS):
            part = stream[at : at + BLOCK_TOKENS + 2 * WINDOW]
            logs[at : at + BLOCK_TOKENS] = self.network.log_probs(part)
        return sums_by(logs[place] - self.vocabulary.spread[tokens], counts)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Words of all whole texts: ``word``, its ``hash``, its ``rare`` number, ``n``.

    Words are counted within a task first, so a very frequent word is one row a task.
    """
    bounded_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for batch in table.combine_chunks().to_batches(10_000):
                hashes = word_hashes(batch.column(0))
                columns = [batch.column(0), hashes.view(np.int64), rare_numbers(hashes), batch.column(1)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["word", "hash", "rare", "n"])

        parts: list[pa.Table] = []
        for batch in batches:
            counts = pc.value_counts(ascii_words(batch.column(0))[0])
            parts.append(pa.table({"word": counts.field(0), "n": counts.field(1)}))
            if sum(p.num_rows for p in parts) > 400_000:
                parts = [merged(parts)]
                if parts[0].num_rows > 200_000:
                    yield from out(parts.pop())
        if parts:
            yield from out(merged(parts))

    parts = docs.select(text_of(text_col).alias("_text")).mapInArrow(counted, "word string, hash long, rare long, n long")
    return parts.groupBy("word", "hash", "rare").agg(F.sum("n").alias("n"))


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """From the counts of all words (between ASCII white space) of all texts.

    The driver gets ``TOKENS`` words or numbers and ``KNOWN`` words at most,
    whatever the corpus holds.
    """
    top = counts.orderBy(F.desc("n"), "word").limit(TOKENS - 1 - RARE).select("hash", "rare", "n").collect()
    behind = np.zeros(TOKENS)
    for row in counts.groupBy("rare").agg(F.sum("n").alias("n")).collect():
        behind[row.rare] = row.n
    for row in top:
        behind[row.rare] -= row.n
    spread = np.zeros(TOKENS)
    # One more for words that no text had.
    spread[1 : RARE + 1] = np.log(behind[1 : RARE + 1] + 1)
    frequent = np.unique(np.array([row.hash for row in top], np.int64).view(np.uint64))
    return Vocabulary(frequent, spread, *_known(counts))


def _known(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and log counts of all words from a power of two of occurrences on, at most ``KNOWN``."""
    power = F.floor(F.log2("n")).cast("int")
    least, words = 64, 0
    for row in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("power")).collect():
        words += row.words
        if words > KNOWN:
            break
        least = row.power
    # Words that occur once add nothing.
    rows = counts.filter((power >= least) & (F.col("n") > 1)).select("hash", "n").toArrow()
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log(rows.column("n").to_numpy())[order]


def train_share(docs: DataFrame, model: LanguageModel, text_col: str) -> Network | None:
    """One pass over the texts in all tasks at once; the mean network by tokens seen.

    Each task starts from the given network and trains on its own texts. The
    weighted parameters are summed by place in the network, so the driver gets
    one network, however many tasks there were. None if there is no token.
    """
    model = replace(model, counts=None)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(model.network)
        for batch in batches:
            trainer.take(*model.vocabulary.numbers(batch.column(0)))
        if trainer.tokens:
            values = trainer.network.flat().astype(np.float64) * trainer.tokens
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(len(values), dtype=np.int32)),
                    pa.array(values),
                    pa.array(np.full(len(values), trainer.tokens, np.int64)),
                ],
                ["place", "value", "tokens"],
            )

    parts = docs.select(text_of(text_col).alias("_text")).mapInArrow(
        trained, "place int, value double, tokens long"
    )
    rows = parts.groupBy("place").agg((F.sum("value") / F.sum("tokens")).alias("value")).toArrow()
    if not rows.num_rows:
        return None
    values = np.zeros(rows.num_rows)
    values[rows.column("place").to_numpy()] = rows.column("value").to_numpy()
    return model.network.with_flat(values)


def train_language_model(docs: DataFrame, text_col: str = "text") -> LanguageModel:
    """Vocabulary from all texts, then ``SHARES`` rounds; each document trains in one of them."""
    counts = written(word_counts(docs, text_col), "word-counts")
    model = LanguageModel(learn_vocabulary(counts), Network.fresh(), counts.select("hash", "n"))
    share = F.pmod(F.xxhash64(text_of(text_col)), F.lit(SHARES))
    for i in range(SHARES):
        network = train_share(docs.filter(share == i), model, text_col)
        model = replace(model, network=network or model.network)
    return model


def score_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``log_prob`` (sum over its tokens), ``mean_log_prob``.

    Every token is predicted from two tokens to each side; outside the text
    stands a mark. A word behind a hashed number has its share of that number's
    occurrences in the corpus. A text without words, null included, has no token,
    a sum of 0 and a null mean. Repeated rows and null ids get a row each; other
    columns are ignored. Sums are rounded to three decimals, as single precision
    allows.

    Counts of words that tasks don't know by themselves are joined by hash. Each
    of those has less than one in ``KNOWN`` / 2 of all occurrences, so none is a
    hot key, also in a corpus of many more words.
    """
    bounded_batches(docs.sparkSession)
    bare = replace(model, counts=None)

    @F.arrow_udf("struct<n: long, total: double, rest: array<long>>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n, total, rest, of_text = bare.looked_up(batch)
            ends = np.concatenate([[0], np.cumsum(of_text)]).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(ends), pa.array(rest.view(np.int64)))
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(total, pa.float64()), rest], ["n", "total", "rest"]
            )

    scored = docs.select(F.col(id_col).alias("id"), judged(text_of(text_col)).alias("lm"))
    more = F.lit(0)
    if model.counts is not None:
        scored = written(scored.select("id", "lm", F.monotonically_increasing_id().alias("row")), "lm-scored")
        counts = model.counts.groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1")
        rest = scored.select("row", F.explode("lm.rest").alias("hash"))
        # Whole millionths add up to the same in any order.
        log = F.round(F.log("n") * 1_000_000).cast("long")
        joined = rest.join(counts.hint("merge"), "hash").groupBy("row").agg(F.sum(log).alias("more"))
        scored = scored.select("row", "id", "lm.n", "lm.total").join(joined.hint("merge"), "row", "left")
        more = F.coalesce(F.col("more"), F.lit(0)) / 1_000_000
    else:
        scored = scored.select("id", "lm.n", "lm.total")
    scored = scored.withColumn("total", F.round(F.col("total") + more, 3))
    return scored.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_tokens"),
        F.col("total").alias("log_prob"),
        F.round(F.try_divide("total", "n"), 6).alias("mean_log_prob"),
    )
