"""Conversation structure repair by weighted CYK parsing over spans of turns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches
from tidemark.session import written

# Costs of the edits, and of leaving a cut-off turn in.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5

# What a conversation may be is s?(ua)+ or nothing. Before any turn, then after a turn of
# the system, the user, the assistant; which turn leads from where to where.
STATES = "-sua"
STEPS = {("-", "s"): "s", ("-", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FINAL = "-a"
ROLE = {"u": "user", "a": "assistant"}

# A cell: for each nonterminal, here a pair of states, the least (cost, audit) of a span
# that leads from one to the other. Audits are the initials of the edits in order.
Cell = dict[tuple[str, str], tuple[int, str]]

# Spans of up to so many turns are remembered by their turns' kinds.
REMEMBERED_SPAN = 16


def _least(cell: Cell, pair: tuple[str, str], entry: tuple[int, str]) -> None:
    if pair not in cell or entry < cell[pair]:
        cell[pair] = entry


def joined(left: Cell, right: Cell) -> Cell:
    """Rules P-Q -> P-R R-Q over two neighbouring spans.

    Of two audits of one cost for the same turns none begins with the other: it
    would have more insertions. So the least of the whole has the least parts.
    """
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                _least(out, (p, q), (cost + more, audit + rest))
    return out


def _insertions() -> Cell:
    """The insertion closure: what insertions alone lead to, at the least cost."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    single: Cell = {(p, q): (INSERT, "I") for (p, turn), q in STEPS.items() if turn in ROLE}
    while True:
        more = joined(cell, {**single, **{(p, p): (0, "") for p in STATES}})
        if more == cell:
            return cell
        cell = more


INSERTIONS = _insertions()


@lru_cache(maxsize=100_000)
def turn_cell(kind: str) -> Cell:
    """One turn and the insertions round it. Its kind: initial (or a dot), and x if it must go, c if cut off."""
    initial, fault = kind[0], kind[1]
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    if fault != "x":
        extra = CUT_OFF if fault == "c" else 0
        for (p, turn), q in STEPS.items():
            if turn == initial:
                _least(cell, (p, q), (extra, "K"))
            elif turn in ROLE:
                _least(cell, (p, q), (extra + REROLE, "R"))
    return joined(joined(INSERTIONS, cell), INSERTIONS)


@lru_cache(maxsize=100_000)
def _short_span(kinds: str) -> Cell:
    n = len(kinds) // 2
    if n == 1:
        return turn_cell(kinds)
    half = 2 ** ((n - 1).bit_length() - 1)
    return joined(_short_span(kinds[: 2 * half]), _short_span(kinds[2 * half :]))


def span_cell(kinds: str) -> Cell:
    """The cell of a span of turns (two characters each), bottom-up by span length.

    Every pair of states is a nonterminal, so a parse can be cut at any turn and
    each cut of a span gives the same cell; one cut of each span is enough.
    """
    step = 2 * REMEMBERED_SPAN
    cells = [_short_span(kinds[i : i + step]) for i in range(0, len(kinds), step)] or [INSERTIONS]
    while len(cells) > 1:
        pairs = [joined(*cells[i : i + 2]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def best_parse(cell: Cell) -> tuple[int, str]:
    return min(cell["-", q] for q in FINAL if ("-", q) in cell)


def through(cells: list[Cell]) -> list[tuple[str, str]]:
    """The pairs of states by which the best parse goes through neighbouring spans."""
    best: dict[str, tuple[tuple[int, str], tuple[str, ...]]] = {"-": ((0, ""), ("-",))}
    for cell in cells:
        further: dict[str, tuple[tuple[int, str], tuple[str, ...]]] = {}
        for p, ((cost, audit), path) in best.items():
            for q in STATES:
                if (p, q) in cell:
                    entry = ((cost + cell[p, q][0], audit + cell[p, q][1]), (*path, q))
                    if q not in further or entry < further[q]:
                        further[q] = entry
        best = further
    _, path = min(best[q] for q in FINAL if q in best)
    return list(zip(path, path[1:]))


# --- damage ----------------------------------------------------------------------------


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows with their ``_fault``, chosen by a hash of id and turn: dropped, emptied, cut off, repeated, of another role.

    Null roles and texts become one space first, and null ids and turns count as one in the hash.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (id_col, turn_col)]
    chosen = F.crc32(F.concat_ws(":", *named)) % 20
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    text = F.when(chosen == 1, "").when(chosen == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.when(chosen == 0, F.array().cast("array<int>")).when(chosen == 3, F.array(F.lit(0), F.lit(1)))
    return rows.select(
        F.col(id_col), F.col(turn_col), F.when(chosen == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"), F.explode_outer(copies.otherwise(F.array(F.lit(0)))).alias("copy"),
    ).withColumn("dropped", F.col("copy").isNull())


# --- parsing on Spark ------------------------------------------------------------------

SPAN = (
    "conv {kind}, first long, n long, kinds string, n_illegal long, head string, tail string, blank long, "
    "duplicate long, truncated long, low long, high long, turns long, first_turn long, last_turn long"
)
# A span of more turns is cut, so that no task holds more of a conversation.
SPAN_TURNS = 4096


def _illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


def _spans(schema: pa.Schema):
    """Neighbouring turns of one conversation in a task, summed up; rows come in order."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_span, at = None, None
        names = ["conv", "pos", "turn", "initial", "fault"]
        for batch in batches:
            done = []
            for conv, pos, turn, initial, fault in zip(*[batch.column(c).to_pylist() for c in names]):
                if open_span is None or at != (conv, pos) or open_span["n"] == SPAN_TURNS:
                    if open_span is not None:
                        done.append(open_span)
                    open_span = {
                        "conv": conv, "first": pos, "n": 0, "kinds": [], "n_illegal": 0, "head": initial, "tail": None,
                        "blank": 0, "duplicate": 0, "truncated": 0, "low": turn, "high": None, "turns": 0,
                        "first_turn": turn, "last_turn": None,
                    }
                span = open_span
                if span["n"] and _illegal(span["tail"] + initial):
                    span["n_illegal"] += 1
                if turn is not None and turn != span["last_turn"]:
                    span["turns"] += 1
                    span["low"] = turn if span["low"] is None else span["low"]
                    span["high"] = turn
                mark = {None: "-", "truncated": "c"}.get(fault, "x")
                span["kinds"].append((initial if initial and initial in "sua" else ".") + mark)
                if fault:
                    span[fault] += 1
                span["n"] += 1
                span["tail"], span["last_turn"] = initial, turn
                at = (conv, pos + 1)
            if done:
                yield _span_batch(done, schema)
        yield _span_batch([open_span] if open_span else [], schema)

    return spans


def _span_batch(spans: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    rows = [{**s, "kinds": "".join(s["kinds"])} for s in spans]
    return pa.RecordBatch.from_pylist(rows, schema=schema)


REPAIR = (
    "conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "edits array<struct<first: long, audit: string, state: string>>"
)


def _repairs(schema: pa.Schema):
    """One row a conversation from its spans, in order: the parse, and each span's part of it."""

    def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                spans = sorted(row["spans"], key=lambda s: s["first"])
                cells = [span_cell(s["kinds"]) for s in spans]
                path = through(cells)
                parts = [cell[pair] for cell, pair in zip(cells, path)]
                bounds = list(zip(spans, spans[1:]))
                lows = [s["low"] for s in spans if s["low"] is not None]
                highs = [s["high"] for s in spans if s["high"] is not None]
                both = sum(a["last_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in bounds)
                total = lambda name: sum(s[name] for s in spans)  # noqa: E731, B023
                out.append({
                    "conv": row["conv"],
                    "gaps": max(highs) - min(lows) + 1 - (total("turns") - both) if lows else 0,
                    "blank": total("blank"), "duplicate": total("duplicate"), "truncated": total("truncated"),
                    "illegal": total("n_illegal") + sum(_illegal(a["tail"] + b["head"]) for a, b in bounds),
                    "cost": sum(cost for cost, _ in parts), "audit": "".join(audit for _, audit in parts),
                    "edits": [
                        {"first": s["first"], "audit": audit, "state": p}
                        for s, (_, audit), (p, _) in zip(spans, parts, path)
                    ],
                })
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return repairs


def _digests(schema: pa.Schema):
    """The digest of each conversation's repaired turns; edits come before the rows they are of."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha, empty, letters, state = object(), None, True, iter(()), "-"

        def add(line: str) -> None:
            nonlocal empty
            sha.update((line if empty else "\n" + line).encode())
            empty = False

        def step(turn: str) -> None:
            nonlocal state
            state = STEPS[state, turn]

        def insertions() -> str | None:
            """Inserted turns up to the next edit of a row, which is returned."""
            for letter in letters:
                if letter != "I":
                    return letter
                turn = "a" if state == "u" else "u"
                add(f"{ROLE[turn]}:")
                step(turn)
            return None

        for batch in batches:
            done = []
            for conv, edits, start, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "edits", "state", "role", "text")]):
                if sha is None or conv != current:
                    if sha is not None:
                        insertions()
                        done.append({"conv": current, "sha": sha.hexdigest()})
                    current, sha, empty, letters = conv, hashlib.sha256(), True, iter(())
                if edits is not None:
                    insertions()
                    letters, state = iter(edits), start
                    continue
                edit = insertions()
                if edit == "K":
                    add(f"{role}:{text}")
                    step(role[0])
                elif edit == "R":
                    turn = "a" if state == "u" else "u"
                    add(f"{ROLE[turn]}:{text}")
                    step(turn)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
        last = []
        if sha is not None:
            insertions()
            last = [{"conv": current, "sha": sha.hexdigest()}]
        yield pa.RecordBatch.from_pylist(last, schema=schema)

    return digests


def repair_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Per conversation: id, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Turns are taken by ``turn`` (nulls first), rows of one turn by a hash of role
    and text. Faults, of which a row's first counts: blank (no text but ASCII white
    space), duplicate (role and text seen earlier in the conversation), truncated
    (the last character that is no white space is none of ``.!?``). ``gaps`` are
    turns missing between the smallest and the largest, ``illegal`` neighbours
    whose roles may not follow each other. ``cost`` and ``audit`` are the least
    edits (Keep 0, Rerole 1, Delete 2, Insert 5, a cut-off turn that stays 5) after
    which the roles' initials read ``s?(ua)+`` or nothing; of equal cost the audit
    that is least in ASCII. ``repaired_sha256`` is of the repaired ``role:text``
    lines. A column ``dropped``, if there is one, marks rows that only name their
    conversation; one without other rows has zeros, an empty audit and the digest
    of an empty text.

    The grammar is in Chomsky normal form over pairs of states, so a parse of a
    conversation is put together from parses of any spans of it. Rows are dealt
    out by ranges of (id, turn), so a very long conversation lies in many tasks;
    each task parses its spans bottom-up, and one row a span goes on. Digests are
    taken in a stream over sorted rows, in which only the edits of one span are
    held. What must be one value, an audit or a digest, is made in one place.

    Null roles and texts count as one space, a null id is an id like others, null
    turns take no part in gaps. Repeated rows are duplicates. Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    kind = rows.schema[id_col].dataType
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select(
        F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), text(role_col).alias("role"),
        text(text_col).alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"),
    )
    ids = plain.select("conv").distinct()
    turns = plain.filter("not dropped").select(
        "conv", "turn", "role", "text",
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "text", "role").alias("h2"),
    )
    order = ["conv", "turn", "h1", "h2"]
    sorted_turns = turns.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # Numbers that grow with the order and are dense within a part.
    sorted_turns = written(sorted_turns.withColumn("pos", F.monotonically_increasing_id()), "conversation-turns")

    trimmed = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    light = sorted_turns.select(
        "conv", "turn", "pos", "h1", "h2", F.left("role", F.lit(1)).alias("initial"),
        F.when(trimmed == "", "blank").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated").alias("own"),
    )
    seen = light.groupBy("conv", "h1", "h2").agg(F.min("pos").alias("seen"), F.max("pos").alias("last"))
    seen = seen.filter("seen < last").drop("last").hint("merge").alias("s")
    same = (
        F.col("l.conv").eqNullSafe(F.col("s.conv")) & (F.col("l.h1") == F.col("s.h1")) & (F.col("l.h2") == F.col("s.h2"))
    )
    again = F.when((F.col("pos") > F.col("seen")) & ~F.col("own").eqNullSafe("blank"), "duplicate")
    faulty = light.alias("l").join(seen, same, "left").select(
        "l.conv", "pos", "turn", "initial", F.coalesce(again, "own").alias("fault")
    )
    span_schema = _schema(SPAN, kind)
    spans = faulty.repartitionByRange(ranges, "pos").sortWithinPartitions("pos")
    spans = spans.mapInArrow(_spans(_arrow(span_schema)), span_schema)
    by_conv = spans.groupBy("conv").agg(F.collect_list(F.struct(*[c for c in span_schema.names if c != "conv"])).alias("spans"))
    repair_schema = _schema(REPAIR, kind)
    repairs = written(by_conv.mapInArrow(_repairs(_arrow(repair_schema)), repair_schema), "conversation-repairs")

    edits = repairs.select("conv", F.explode("edits").alias("e")).select(
        "conv", F.col("e.first").alias("pos"), F.lit(0).alias("is_row"), F.col("e.audit").alias("edits"),
        F.col("e.state").alias("state"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    nothing = F.lit(None).cast("string")
    lines = sorted_turns.select(
        "conv", "pos", F.lit(1).alias("is_row"), nothing.alias("edits"), nothing.alias("state"), "role", "text"
    )
    digest_schema = _schema("conv {kind}, sha string", kind)
    digests = (
        edits.union(lines).repartition(ranges, "conv").sortWithinPartitions("conv", "pos", "is_row")
        .mapInArrow(_digests(_arrow(digest_schema)), digest_schema)
    )
    done = repairs.drop("edits").alias("r").join(
        digests.hint("merge").alias("d"), F.col("r.conv").eqNullSafe(F.col("d.conv"))
    )
    all_ids = ids.alias("i").join(done, F.col("i.conv").eqNullSafe(F.col("r.conv")), "left")
    counts = [F.coalesce(F.col(f"r.{c}"), F.lit(0)).cast("long").alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return all_ids.select(
        F.col("i.conv").alias(id_col), *counts, F.coalesce("r.audit", F.lit("")).alias("audit"),
        F.coalesce("d.sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _schema(ddl: str, kind: T.DataType) -> T.StructType:
    return T.StructType.fromDDL(ddl.format(kind=kind.simpleString()))


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
