"""Expressions for the operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def upto(n: Column) -> Column:
    """0 to n - 1; empty for n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def id_key(col: Column) -> Column:
    """The id as a text to join on; a null id is a value like any other."""
    return F.coalesce(F.concat(F.lit("#"), col.cast("string")), F.lit(""))


# Bits of a bitmap of keys: 16 MB, whatever the number of keys.
MARKS = 2**27


def with_mark(df: DataFrame, key: str, wanted: DataFrame, mark: str) -> DataFrame:
    """``df`` and whether its key may be one of ``wanted`` (one column), without a shuffle.

    The keys' hashes are marked in a bitmap of bounded size, which is broadcast. Every
    row of a wanted key is marked; others are by chance, and more of them the more
    keys there are, so an exact join follows where it matters. Null keys are not.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(MARKS)) + 1  # noqa: E731  bitmaps count from 1
    marked = wanted.select(spot(F.col(wanted.columns[0])).alias("_spot")).groupBy(
        F.bitmap_bucket_number("_spot").alias("_bitmap")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_spot")).alias("_bits"))
    at = F.bitmap_bit_position(spot(F.col(key)))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    here = F.col(key).isNotNull() & (F.col("_bitmap") == F.bitmap_bucket_number(spot(F.col(key))))
    found = df.join(F.broadcast(marked), here, "left")
    return found.select(*df.columns, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias(mark))


def maybe_among(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key may be one of ``wanted``: all of those, and some others by chance."""
    return with_mark(df, key, wanted, "_marked").filter("_marked").drop("_marked")
