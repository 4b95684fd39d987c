"""Queries for the data checks, each over a whole table with violations in it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import shared_dir
from tidemark.operators.quality import (
    Check,
    accepted_values,
    array_length,
    between,
    compound_unique,
    failing,
    no_overlap,
    not_null,
    relationships,
    report_one,
    written_with_report,
    unique,
)
from tidemark.plans.checks import MODEL_CHECKS, SOURCE_CHECKS
from tidemark.plans.build import check_report, models_to_check
from workload.models import MODEL_SQL, models, with_models
from workload.operators import overlap_sql
from workload.registry import SQL, query
from workload.standins import RAW_SQL, given, raw

_EVENTS_SQL = """
    SELECT event_id, event_type, value,
           CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
           CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '{}' WHEN 'error' THEN '[]'
                WHEN 'signup' THEN '["a","b"]' ELSE '["a"]' END AS tags
    FROM events
"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    tags = (
        F.when(kind == "view", F.lit(None).cast("string"))
        .when(kind == "click", "{}")
        .when(kind == "error", "[]")
        .when(kind == "signup", '["a","b"]')
        .otherwise('["a"]')
    )
    return given(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "value",
        F.when(kind != "error", F.col("user_id")).alias("user_id"),
        tags.alias("tags"),
    )


_COLUMNS = "event_id, event_type, value, user_id, tags"


@query("dq_not_null", f"SELECT {_COLUMNS} FROM ({_EVENTS_SQL}) WHERE user_id IS NULL")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing(_events(spark, sf_dir), not_null("user_id")[0])


@query(
    "dq_unique",
    f"""
    SELECT user_id, count(*) AS n_records FROM ({_EVENTS_SQL}) WHERE user_id IS NOT NULL
    GROUP BY 1 HAVING count(*) > 1
    """,
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing(_events(spark, sf_dir), unique("user_id")[0])


@query(
    "dq_accepted_values",
    f"SELECT {_COLUMNS} FROM ({_EVENTS_SQL}) WHERE event_type IN ('signup', 'error')",
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = accepted_values("event_type", ["view", "click", "purchase"])[0]
    return failing(_events(spark, sf_dir), check)


@query(
    "dq_relationships",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) AND l_linenumber < 7
    """,
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose part is unknown; a line without a part number is no orphan."""
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") < 7, F.col("l_partkey")).alias("l_partkey"),
    )
    parts = given(spark, sf_dir, "part").filter(F.col("p_size") > 5)
    check = relationships("l_partkey", "part", "p_partkey")[0]
    return failing(lines, check, {"part": parts})


@query(
    "dq_between",
    f"""
    SELECT {_COLUMNS} FROM ({_EVENTS_SQL})
    WHERE (user_id < 20 OR user_id > 100) AND event_type <> 'view'
    """,
)
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = between("user_id", 20, 100, where="event_type <> 'view'")[0]
    return failing(_events(spark, sf_dir), check)


@query(
    "dq_compound_unique",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def dq_compound_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = compound_unique("l_orderkey", "l_linenumber")[0]
    return failing(given(spark, sf_dir, "lineitem"), check)


@query(
    "dq_array_length",
    f"""
    SELECT {_COLUMNS} FROM ({_EVENTS_SQL})
    WHERE tags IS NULL OR tags = '{{}}' OR json_array_length(tags) NOT BETWEEN 1 AND 1
    """,
)
def dq_array_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, an object instead of a list, an empty list and too long a list all fail."""
    return failing(_events(spark, sf_dir), array_length("tags", 1, 1)[0])


_REPORT_CHECKS = [
    *not_null("event_id", "user_id"),
    *accepted_values("event_type", ["view", "click", "purchase"]),
    *between("value", 1, 300),
    *array_length("tags", 1, 1),
    *unique("event_id"),
    *unique("user_id"),
    *compound_unique("user_id", "event_type"),
    *relationships("user_id", "customer", "c_custkey"),
]


@query(
    "dq_report",
    f"""
    WITH e AS ({_EVENTS_SQL}),
    counted AS (
        SELECT 'not_null' AS "check", 'event_id' AS target,
               count(*) FILTER (WHERE event_id IS NULL) AS failures FROM e
        UNION ALL SELECT 'not_null', 'user_id', count(*) FILTER (WHERE user_id IS NULL) FROM e
        UNION ALL SELECT 'accepted_values', 'event_type',
               count(*) FILTER (WHERE event_type IN ('signup', 'error')) FROM e
        UNION ALL SELECT 'between', 'value', count(*) FILTER (WHERE value < 1 OR value > 300) FROM e
        UNION ALL SELECT 'array_length', 'tags',
               count(*) FILTER (WHERE event_type <> 'purchase') FROM e
        UNION ALL SELECT 'unique', 'event_id', count(*)
               FROM (SELECT event_id FROM e GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique', 'user_id', count(*)
               FROM (SELECT user_id FROM e WHERE user_id IS NOT NULL
                     GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'compound_unique', 'user_id,event_type', count(*)
               FROM (SELECT user_id, event_type FROM e GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'relationships', 'user_id', count(*)
               FROM e WHERE user_id NOT IN (SELECT c_custkey FROM customer))
    SELECT 'events' AS model, "check", target, failures, failures = 0 AS passed FROM counted
    """,
)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"customer": given(spark, sf_dir, "customer")}
    return report_one(_events(spark, sf_dir), "events", _REPORT_CHECKS, tables)


@query("dq_report_on_write", SQL["dq_report"])
def dq_report_on_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, where the one-row checks are counted by the pass that writes the table."""
    tables = {"customer": given(spark, sf_dir, "customer")}
    _, report, _ = written_with_report(_events(spark, sf_dir), "events", _REPORT_CHECKS, tables)
    return report


_EMPTY_LINKS = """(SELECT CAST(NULL AS VARCHAR) AS row_id, CAST(NULL AS BIGINT) AS engagement_id,
    CAST(NULL AS BIGINT) AS company_id WHERE false)"""


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def _failures_sql(table: str, check: Check) -> str:
    """Number of failures of one check, as a scalar query."""
    column = check.columns[0]
    keys = ", ".join(check.columns)
    if check.kind == "not_null":
        return f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
    if check.kind == "accepted_values":
        allowed = ", ".join(f"'{v}'" for v in check.values)
        return f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({allowed})"
    if check.kind == "between":
        low, high = _literal(check.low), _literal(check.high)
        return f"SELECT count(*) FROM {table} WHERE {column} < {low} OR {column} > {high}"
    if check.kind in ("unique", "compound_unique"):
        known = " OR ".join(f"{c} IS NOT NULL" for c in check.columns)
        return f"""SELECT count(*) FROM (SELECT {keys} FROM {table} WHERE {known}
                   GROUP BY {keys} HAVING count(*) > 1)"""
    if check.kind == "relationships":
        return f"""SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL AND NOT EXISTS
                   (SELECT 1 FROM {check.parent} p WHERE p.{check.field} = c.{column})"""
    start, end = check.columns
    return f"""SELECT count(*) FROM (SELECT {end} AS stop, lead({start}) OVER
               (ORDER BY {start}, {end}) AS following FROM {table}) WHERE stop > following"""


def _suite_sql() -> str:
    names = [*RAW_SQL, *MODEL_SQL]
    parts = []
    for table, checks in {**SOURCE_CHECKS, **MODEL_CHECKS}.items():
        if table not in names and table != "stg_hubspot__engagement_companies":
            continue
        source = table if table in names else _EMPTY_LINKS
        for check in checks:
            parts.append(
                f"""SELECT '{table}' AS model, '{check.kind}' AS "check",
                    '{check.target}' AS target, ({_failures_sql(source, check)}) AS failures"""
            )
    rows = " UNION ALL ".join(parts)
    return with_models(f"SELECT *, failures = 0 AS passed FROM ({rows})", *names)


@query("dq_model_suite", _suite_sql())
def dq_model_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared check on every source table and model, over the stand-ins."""
    sources = {n: raw(spark, sf_dir, n) for n in RAW_SQL}
    return check_report(sources, models_to_check(sources, shared_dir(spark, "models")))


@query(
    "dq_no_overlap",
    with_models(
        overlap_sql(
            "", "", "SELECT started_at AS started, ended_at AS ended FROM stg_fitbit__sleep"
        ),
        "stg_fitbit__sleep",
    ),
)
def dq_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    sleep = models(spark, sf_dir, "stg_fitbit__sleep")["stg_fitbit__sleep"]
    found = failing(sleep, no_overlap("started_at", "ended_at")[0])
    return found.withColumnsRenamed({"started_at": "started", "ended_at": "ended"})
