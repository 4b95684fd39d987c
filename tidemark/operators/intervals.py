"""Overlapping intervals without a self-join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import SHARE, frequent_keys, spread_join
from tidemark.session import written

_KEYS = "__key"
_DAY = 86400


def interval_overlaps(
    df: DataFrame,
    start: str,
    end: str,
    entity: Sequence[str] = (),
    bucket_seconds: int = 60,
    share: int = SHARE,
    units_per_second: int = 1000,
) -> DataFrame:
    """Intervals that end after the next one (by start, then end) begins.

    If any two intervals overlap, so do two neighbours. The columns are
    ``entity``, start, end, ``next_start`` and ``n_overlaps``: how many logs with
    these bounds run into the next log. Copies overlap each other.

    A plain ``lead`` over one entity would sort all its rows in one task. Here
    copies are counted before the shuffle and only distinct starts are put in
    order, within an entity and a time bucket; the first start of each bucket is
    handed across, first among the buckets of a day, then from day to day. So a
    window sees the instants of one minute, the minutes of one day, or one row per
    day of the time span (365 a year), however many logs the entity has.

    Numeric starts count ``units_per_second``; times and dates need no unit. An
    empty table gives no rows, nulls in the start are left out.
    """
    entity = list(entity)
    logs = (
        df.filter(F.col(start).isNotNull())
        .groupBy(
            F.struct(F.lit(0).alias("all"), *entity, F.col(start).alias("start")).alias(_KEYS),
            F.col(end).alias("__end"),
        )
        .agg(F.count(F.lit(1)).alias("__copies"))
    )
    logs = written(logs, "intervals")  # read four times below
    who = [f"{_KEYS}.{c}" for c in ("all", *entity)]
    starts = (
        logs.groupBy(_KEYS)
        .agg(F.max("__end").alias("__last_end"))
        .withColumn("__bucket", _bucket(df, start, bucket_seconds, units_per_second))
    )
    within = Window.partitionBy(*who, "__bucket").orderBy(f"{_KEYS}.start")
    ordered = starts.withColumn("__next", F.lead(f"{_KEYS}.start").over(within))

    firsts = starts.groupBy(
        F.struct(*who).alias("__who"), F.col("__bucket").alias("__at")
    ).agg(F.min(f"{_KEYS}.start").alias("__first"))
    following = _handed_across(firsts, max(1, _DAY // bucket_seconds))
    same = (F.struct(*who) == F.col("__who")) & (F.col("__bucket") == F.col("__at"))
    linked = ordered.join(following, same, "left").select(
        _KEYS, "__last_end", F.coalesce("__next", "__next_bucket").alias("__next")
    )

    # Every log but the last of its start is followed by a log with the same start.
    frequent = frequent_keys(logs, [_KEYS], share=share)[0]
    joined = spread_join(logs, linked, [_KEYS], "inner", frequent)
    begin, stop = F.col(f"{_KEYS}.start"), F.col("__end")
    is_last = F.coalesce(stop == F.col("__last_end"), F.col("__last_end").isNull())
    tied = F.col("__copies") - F.when(is_last, 1).otherwise(0)
    into_tied = F.when(stop > begin, tied).otherwise(0)
    into_next = F.when(is_last & (stop > F.col("__next")), 1).otherwise(0)
    return joined.select(
        *[F.col(f"{_KEYS}.{c}").alias(c) for c in entity],
        begin.alias(start),
        stop.alias(end),
        F.when(into_tied > 0, begin).otherwise(F.col("__next")).alias("next_start"),
        (into_tied + into_next).cast("bigint").alias("n_overlaps"),
    ).filter(F.col("n_overlaps") > 0)


def _handed_across(firsts: DataFrame, per_day: int) -> DataFrame:
    """For each bucket that has starts, the first start of the next such bucket."""
    days = firsts.withColumn("__day", F.floor(F.col("__at") / F.lit(per_day)))
    of_day = days.groupBy("__who", "__day").agg(F.min("__first").alias("__day_first"))
    to_day = Window.partitionBy("__who").orderBy("__day")
    next_days = of_day.select(
        F.col("__who").alias("__day_who"),
        F.col("__day").alias("__day_at"),
        F.lead("__day_first").over(to_day).alias("__next_day"),
    )
    in_day = Window.partitionBy("__who", "__day").orderBy("__at")
    days = days.withColumn("__next_in_day", F.lead("__first").over(in_day))
    same = (F.col("__who") == F.col("__day_who")) & (F.col("__day") == F.col("__day_at"))
    return days.join(next_days, same, "left").select(
        "__who", "__at", F.coalesce("__next_in_day", "__next_day").alias("__next_bucket")
    )


def _bucket(df: DataFrame, start: str, seconds: int, units_per_second: int) -> Column:
    kind = df.schema[start].dataType.simpleString()
    at = F.col(f"{_KEYS}.start")
    if kind in ("timestamp", "timestamp_ntz"):
        at = F.unix_seconds(at.cast("timestamp"))
    elif kind == "date":
        at = F.unix_date(at) * F.lit(_DAY).cast("bigint")
    else:
        at = F.floor(at / F.lit(units_per_second))
    return F.floor(at / F.lit(seconds))
