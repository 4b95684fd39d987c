"""Line dedup by content-defined chunks of lines, by DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.native import id_key, let, upto
from tidemark.session import written

# Factor of the rolling hash over two lines; line hashes have 57 bits, so it fits a long.
FACTOR = 31


def line_hash(line: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(line), 7)


def is_filled(line: Column) -> Column:
    """Whether a line has more than white space."""
    return F.trim(F.translate(line, "\t\r", "")) != ""


def pairs(lines: Column) -> Column:
    """Neighbouring filled lines in order: ``first`` and ``last`` (numbers from 0) and the rolling ``hash`` over both."""

    def of(filled: Column) -> Column:
        return F.transform(
            upto(F.size(filled) - 1),
            lambda k: F.struct(
                filled[k]["i"].alias("first"),
                filled[k + 1]["i"].alias("last"),
                (filled[k]["h"] * FACTOR + filled[k + 1]["h"]).alias("hash"),
            ),
        )

    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("i"), F.when(is_filled(line), line_hash(line)).alias("h")))
    return let(F.filter(numbered, lambda x: x["h"].isNotNull()), of)


def pair_text(lines: Column, pair: Column) -> Column:
    return F.concat(F.get(lines, pair["first"]), F.lit("\n"), F.get(lines, pair["last"]))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns, with repeated chunks of two lines or more taken out of the text.

    A hash rolls over each two neighbouring lines, blank ones passed over. Chunks
    end where it turns from a pair of lines that an earlier place (id, number) has,
    byte for byte, to one that none has: so a chunk is a longest run of repeated
    lines, and an end hangs on two lines alone, wherever the run stands and
    whatever is round it. These chunks go, with the blank lines inside; the first
    place of each pair keeps it. A repeated line between two new ones stays.

    ``n_lines`` is the number of lines before, ``n_removed`` of those taken out;
    input columns of these names are replaced. Lines end at line feeds. Null counts
    as empty text, of one empty line. A null id comes before all others. Rows that
    share an id and a text are one place: what one keeps the other keeps too; rows
    that share only the id follow each other by a hash of the text. An empty table
    stays empty.

    Pairs meet by hash first, as narrow rows; only the texts of those whose hash
    occurs twice are shuffled and grouped by their bytes. Grouping works within
    tasks first, so a passage in very many documents is no large group anywhere.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), id_key(F.col(id_col)).alias("key"), F.xxhash64(text).alias("tie"), text.alias("text")
    )
    found = rows.select("id", "key", "tie", F.posexplode(pairs(F.split("text", "\n"))).alias("number", "pair"))
    found = written(found.select("key", "tie", "number", F.col("pair.hash").alias("hash")), "line-pairs")
    twice = written(
        found.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("hash"),
        "line-twice",
    )
    asked = found.join(twice, "hash").groupBy("key", "tie").agg(F.collect_set("number").alias("numbers"))
    asked = written(asked, "line-asked").hint("merge")
    asked_texts = let(
        F.split("text", "\n"),
        lambda lines: let(
            pairs(lines),
            lambda p: F.transform(
                F.array_sort("numbers"), lambda k: F.struct(k.alias("number"), pair_text(lines, p[k]).alias("text"))
            ),
        ),
    )
    plain = rows.join(asked, ["key", "tie"])
    texts = plain.select("id", "key", "tie", F.explode(asked_texts).alias("pair")).select("id", "key", "tie", "pair.*")
    texts = written(texts, "line-texts")
    place = F.struct("id", "tie", "number")
    first = written(
        texts.groupBy("text").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last").drop("last"),
        "line-first",
    )
    gone = (
        texts.join(first, "text")
        .filter(~place.eqNullSafe(F.col("first")))
        .groupBy("key", "tie").agg(F.collect_set("number").alias("gone"))
    )
    gone = written(gone, "line-gone").hint("merge")
    # All input columns travel as one, so that none clashes with what is added here.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(row, id_key(F.col(id_col)).alias("key"), F.xxhash64(text).alias("tie"))
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    whole = whole.join(gone, ["key", "tie"], "left").select("row", "gone", text.alias("text"))
    lines = F.split("text", "\n")

    def cleaned(line_list: Column) -> Column:
        covered = let(
            pairs(line_list),
            lambda p: F.flatten(F.transform("gone", lambda k: F.sequence(p[k]["first"], p[k]["last"]))),
        )
        kept = F.array_except(upto(F.size(line_list)), covered)
        return let(
            kept,
            lambda k: F.struct(
                F.array_join(F.transform(k, lambda i: F.get(line_list, i)), "\n").alias("text"), F.size(k).alias("n")
            ),
        )

    out = whole.select(
        "row", "text", F.size(lines).alias("n"),
        F.when(F.col("gone").isNotNull(), let(lines, cleaned)).alias("clean"),
    )
    return out.select(
        *[
            F.coalesce("clean.text", "text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
            for c in docs.columns
            if c not in ("n_lines", "n_removed")
        ],
        F.col("n").cast("long").alias("n_lines"),
        F.coalesce(F.col("n") - F.col("clean.n"), F.lit(0)).cast("long").alias("n_removed"),
    )
