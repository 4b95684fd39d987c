"""Queries over the given tables against DuckDB, at the smallest scale."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from workload.registry import QUERIES, SQL
from workload.standins import GIVEN

SF_DIR = "/root/testdata/sf0.001"

# Covered by other tests (loads) or by the marts that are built on them (staging).
ELSEWHERE = {
    "incremental_append", "incremental_append_stream", "full_refresh", "merge_upsert",
    "route_tables", "habits_v1", "measure_habits", "measure_engagements", "dq_model_suite",
}
NAMES = [
    n for n in SQL
    if n not in ELSEWHERE and not n.startswith(("stg_", "base_"))
]

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in GIVEN:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return float(f"{v:.12g}") if isinstance(v, float) else v

    return Counter(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    mine = _bag(df.columns, df.collect())
    assert mine == _bag(columns, result.fetchall())
    assert mine


def test_every_query_with_sql_is_registered():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
