"""Raw tables made from the given tables.

The sources themselves are not at hand, so each raw table is a projection of a
given table that keeps all its rows, most of them in two versions. The text runs
on Spark and on DuckDB; ``{versions}`` gives each row a version ``v`` of 0 and 1.
Nulls, ties, unknown ids and duplicates are put in on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SPARK_VERSIONS = "LATERAL VIEW explode(array(0, 1)) versions AS v"
DUCKDB_VERSIONS = "CROSS JOIN (SELECT unnest([0, 1]) AS v) versions"

# Habit names by nation key; 'Meet Group' has no reference row on purpose.
HABIT_NAMES = (
    "Devotional", "Journal", "Prayer", "Read Bible", "Workout", "Language",
    "Fast", "Church", "Community", "Cook", "Cardio", "Sabbath", "Date Night",
    "Budget", "Serve", "Travel", "Blog", "Goal Review", "Training",
    "Prayer Minutes", "Screen Minutes", "Sleep Minutes", "Steps", "Meet 1to1", "Unused",
)
_NAME_CASE = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(HABIT_NAMES))

_DAY = "INTERVAL '1' DAY"


def _engagement(kind: str, body: str, at: str, status: str, priorities: str) -> str:
    """Version 0 goes by order status, version 1 by priority: an id may change type."""
    return f"""
        SELECT o_orderkey AS id, o_orderpriority AS {body}, o_orderdate AS {at},
               o_orderdate AS created_at,
               o_orderdate + {_DAY} * (v * (CAST(o_orderkey % 3 AS INT) - 1)) AS updated_at
        FROM {{orders}} {{versions}}
        WHERE (v = 0 AND o_orderstatus = '{status}')
           OR (v = 1 AND o_orderpriority IN ({priorities}))"""


def _links(kind: str, flag: str) -> str:
    return f"""
        SELECT l_partkey AS to_object_id,
               CASE WHEN l_linenumber < 7 THEN l_orderkey END AS _hubspot__{kind}_id,
               l_shipdate AS _hubspot__{kind}_updated_at
        FROM {{lineitem}} WHERE l_returnflag = '{flag}'"""


RAW_SQL: dict[str, str] = {
    "hubspot__companies": f"""
        SELECT s_suppkey AS id, s_name || '/' || CAST(v AS STRING) AS properties__name,
               TIMESTAMP '2021-01-01 00:00:00' + {_DAY} * s_nationkey AS properties__createdate,
               TIMESTAMP '2022-01-01 00:00:00' + {_DAY} * (v * (s_nationkey % 3))
                   AS properties__hs_lastmodifieddate,
               CASE s_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'tier_x' WHEN 2 THEN ''
                    ELSE 'tier_' || CAST(s_nationkey % 3 + 1 AS STRING) END
                   AS properties__hs_ideal_customer_profile
        FROM {{supplier}} {{versions}}""",
    "hubspot__contacts": f"""
        SELECT c_custkey AS id,
               CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_nationkey * 5 END
                   AS properties__associatedcompanyid,
               lower(c_name) || '@example.org' AS properties__email,
               c_mktsegment || '/' || CAST(v AS STRING) AS properties__firstname,
               c_name AS properties__lastname,
               TIMESTAMP '2021-01-01 00:00:00' + {_DAY} * c_nationkey AS properties__createdate,
               TIMESTAMP '2022-01-01 00:00:00' + {_DAY} * (v * (c_nationkey % 3 - 1))
                   AS properties__lastmodifieddate
        FROM {{customer}} {{versions}}""",
    "hubspot__meetings": _engagement(
        "meetings", "properties__hs_meeting_body", "properties__hs_meeting_start_time",
        "F", "'1-URGENT', '2-HIGH'",
    ),
    "hubspot__calls": _engagement(
        "calls", "properties__hs_call_body", "properties__hs_timestamp", "O", "'3-MEDIUM'"
    ),
    "hubspot__communications": _engagement(
        "communications", "properties__hs_communication_body", "properties__hs_timestamp",
        "P", "'4-NOT SPECIFIED', '5-LOW'",
    ),
    "hubspot__meetings_to_contacts": _links("meetings", "A"),
    "hubspot__calls_to_contacts": _links("calls", "N"),
    "hubspot__communications_to_contacts": _links("communications", "R"),
    "fitbit__sleep": f"""
        SELECT event_id AS log_id,
               CAST(ts AS DATE) + CAST(v * (event_id % 2) AS INT) AS date_of_sleep,
               CAST(round(value * 100000) AS BIGINT) + v * 3600000 AS duration,
               ts AS start_time,
               ts + INTERVAL '1' SECOND * CAST(round(value * 100) AS INT) AS end_time,
               event_type AS type, 'auto' AS log_type
        FROM {{events}} {{versions}}""",
    "fitbit__activities": """
        SELECT l_orderkey * 10 + l_linenumber AS log_id,
               CAST(CAST(l_shipdate AS DATE) AS STRING) || 'T06:00:00.000+02:00' AS start_time,
               CASE WHEN l_discount = 0 THEN NULL ELSE CAST(round(l_quantity * 10) AS BIGINT) END
                   AS steps,
               l_shipdate AS last_modified
        FROM {lineitem}""",
    "notion__data_source_daily_habits": f"""
        SELECT 'db-day' AS parent__data_source_id, 'd-' || CAST(o_orderkey AS STRING) AS id,
               '{{{{"start": "' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '"}}}}'
                   AS properties__date__date,
               o_orderpriority AS properties__name__title,
               o_orderstatus = 'F' AS properties__devotional__checkbox,
               (o_totalprice > 100000) = (v = 1) AS properties__journal__checkbox,
               CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey % 2 = 0 END
                   AS properties__prayer__checkbox,
               o_custkey % 3 = 0 AS properties__read_bible__checkbox,
               o_orderpriority = '1-URGENT' AS properties__workout__checkbox,
               false AS properties__language__checkbox,
               o_orderdate AS created_time,
               o_orderdate + {_DAY} * v AS last_edited_time
        FROM {{orders}} {{versions}}""",
    "notion__data_source_weekly_habits": f"""
        SELECT 'db-week' AS parent__data_source_id, 'w-' || CAST(c_custkey AS STRING) AS id,
               '{{{{"start": "' || CAST(DATE '2024-01-01' + CAST(c_custkey % 70 AS INT) AS STRING)
                   || '"}}}}' AS properties__date__date,
               c_name AS properties__name__title,
               c_nationkey % 2 = 0 AS properties__fast__checkbox,
               CASE c_nationkey % 5 WHEN 0 THEN '{{{{"number": null}}}}'
                    WHEN 1 THEN '{{{{"number": ' || CAST(c_nationkey AS STRING) || '.0}}}}'
                    ELSE '{{{{"number": ' || CAST(c_nationkey AS STRING) || '}}}}' END
                   AS properties__prayer_minutes__formula,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END
                   AS properties__screen_minutes__number,
               c_nationkey % 3 = 0 AS properties__church__checkbox,
               CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE v = 1 END
                   AS properties__community__checkbox,
               c_mktsegment = 'HOUSEHOLD' AS properties__cook__checkbox,
               c_mktsegment = 'MACHINERY' AS properties__cardio__checkbox,
               true AS properties__sabbath__checkbox,
               false AS properties__date_night__checkbox,
               TIMESTAMP '2024-01-01 00:00:00' AS created_time,
               TIMESTAMP '2024-01-01 00:00:00' + {_DAY} * v AS last_edited_time
        FROM {{customer}} {{versions}}""",
    "notion__data_source_monthly_habits": f"""
        SELECT 'db-month' AS parent__data_source_id, 'm-' || CAST(s_suppkey AS STRING) AS id,
               CASE WHEN s_nationkey < 9 THEN '{{{{"start": "2024-0'
                         || CAST(s_nationkey + 1 AS STRING) || '-01T08:00:00.000Z"}}}}'
                    ELSE '{{{{"start": "2023-12-01"}}}}' END AS properties__date__date,
               s_name AS properties__name__title,
               s_acctbal > 5000 AS properties__budget__checkbox,
               s_acctbal < 0 AS properties__serve__checkbox,
               CASE WHEN s_nationkey % 3 = 0 THEN NULL ELSE v = 1 END
                   AS properties__travel__checkbox,
               true AS properties__blog__checkbox,
               s_nationkey % 2 = 0 AS properties__goal_review__checkbox,
               s_nationkey % 2 = 1 AS properties__training__checkbox,
               TIMESTAMP '2024-01-01 00:00:00' AS created_time,
               TIMESTAMP '2024-01-01 00:00:00' + {_DAY} * v AS last_edited_time
        FROM {{supplier}} {{versions}}""",
    "notion__data_source_habit_reference": f"""
        SELECT 'db-ref' AS parent__data_source_id, 'r-' || CAST(n_nationkey AS STRING) AS id,
               CASE n_nationkey {_NAME_CASE} END AS properties__name__title,
               '{{{{"name": "' || n_name || '"}}}}' AS properties__category__select,
               CASE WHEN n_nationkey < 6 THEN '{{{{"name": "Daily"}}}}'
                    WHEN n_nationkey < 13 THEN '{{{{"name": "Weekly"}}}}'
                    ELSE '{{{{"name": "Monthly"}}}}' END AS properties__frequency__select,
               CASE WHEN n_nationkey < 19 THEN '{{{{"name": "Tickbox"}}}}'
                    WHEN n_nationkey < 22 THEN '{{{{"name": "Number"}}}}' END
                   AS properties__type__select,
               '{{{{"name": "Source ' || CAST(n_regionkey AS STRING) || '"}}}}'
                   AS properties__source__select,
               40 + n_nationkey + v AS properties__target__number,
               CASE WHEN n_nationkey = 23 THEN 20 WHEN n_nationkey % 2 = 0 THEN n_nationkey END
                   AS properties__threshold__number,
               n_nationkey = 20 AS properties__below_threshold__checkbox,
               CASE WHEN n_regionkey = 0 THEN '{{{{"checkbox":false}}}}'
                    ELSE '{{{{"checkbox":true}}}}' END AS properties__active__formula,
               '{{{{"start": "2024-01-01"}}}}' AS properties__start_date__date,
               TIMESTAMP '2024-01-01 00:00:00' AS created_time,
               TIMESTAMP '2024-01-01 00:00:00' + {_DAY} * v AS last_edited_time
        FROM {{nation}} {{versions}}""",
}

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_schemas: dict[str, StructType] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is read from the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = {t: given(spark, sf_dir, t) for t in GIVEN if "{" + t + "}" in RAW_SQL[name]}
    text = RAW_SQL[name].replace("{versions}", SPARK_VERSIONS)
    return spark.sql(text, **used)


def raw_for_duckdb(name: str) -> str:
    names = {t: t for t in GIVEN}
    return RAW_SQL[name].format(versions=DUCKDB_VERSIONS, **names)
