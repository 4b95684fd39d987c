"""Daily date spine and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# First day and exclusive end of the registered spine.
SPINE_START = "2020-01-01"
SPINE_END = "2030-12-31"


def date_spine(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per day in [start, end)."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("stop")
    )
    return spine_between(bounds, "first", "stop")


def spine_between(bounds: DataFrame, first: str, stop: str) -> DataFrame:
    """One row per day in [first, stop) for a one-row frame holding both dates."""
    some = bounds.filter(F.col(first) < F.col(stop))
    days = F.sequence(F.col(first), F.date_sub(F.col(stop), 1))
    return some.select(F.explode(days).alias("date_day"))


def gap_fill(
    spine: DataFrame, daily: DataFrame, date_column: str, values: Sequence[str]
) -> DataFrame:
    """The spine with daily values; days without a row get 0.

    ``daily`` holds one row per day, so both sides are small here.
    """
    series = daily.withColumnRenamed(date_column, "date_day")
    filled = [F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values]
    return spine.join(series, "date_day", "left").select("date_day", *filled)


def gap_fill_by(
    daily: DataFrame, date_column: str, by: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Each group's days from its first to its last, with its values; days without a row get 0.

    ``daily`` holds one row per group and day. A group's days are made of its own
    range, so no group meets the days of another. Null is a group like others; rows
    without a day are left out.
    """
    known = daily.filter(F.col(date_column).isNotNull())
    ranges = known.groupBy(*by).agg(F.min(date_column).alias("__first"), F.max(date_column).alias("__last"))
    days = ranges.select(*by, F.explode(F.sequence("__first", "__last")).alias("date_day")).alias("d")
    same = F.col("d.date_day") == F.col(f"v.{date_column}")
    for c in by:
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"v.{c}"))
    filled = [F.coalesce(F.col(f"v.{v}"), F.lit(0)).alias(v) for v in values]
    joined = days.join(known.alias("v"), same, "left")
    return joined.select(*[F.col(f"d.{c}").alias(c) for c in by], "d.date_day", *filled)
