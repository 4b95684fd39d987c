"""Unions, unpivot, routing and array rows. None of these shuffles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(*branches: DataFrame) -> DataFrame:
    """Stack branches by column position."""
    return reduce(DataFrame.union, branches)


def union_by_name(*branches: DataFrame, fill_missing: bool = False) -> DataFrame:
    """Stack branches by column name."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), branches
    )


def unpivot_flags(
    df: DataFrame,
    ids: Sequence[str],
    flags: Sequence[str],
    name: str,
    value: str,
    keep_null: Sequence[str] = (),
) -> DataFrame:
    """One row per flag column; null flags give no row unless named in ``keep_null``."""
    rows = df.unpivot(list(ids), list(flags), name, value)
    present = F.col(value).isNotNull()
    if keep_null:
        present = present | F.col(name).isin(list(keep_null))
    return rows.filter(present)


def json_array_rows(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per item of a JSON array text; rows without items vanish."""
    items = F.from_json(F.col(column), T.ArrayType(T.StringType()))
    return df.select("*", F.explode(items).alias(alias))


def route_by_key(key: Column | str, targets: Mapping[str, str], prefix: str = "") -> Column:
    """Target table for a key; a key without an entry names its own target."""
    col = (F.col(key) if isinstance(key, str) else key).cast("string")
    known = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
    return F.concat(F.lit(prefix), F.coalesce(F.try_element_at(known, col), col))


def empty_relation(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, right types: a stand-in for a table that is not loaded."""
    return spark.createDataFrame([], schema)
