"""Where queries and their checking SQL are kept, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone (UTC) and decimals as doubles, to compare values."""
    columns = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        columns.append(col.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(configure(spark), sf_dir))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register
