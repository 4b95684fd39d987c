"""The models, built on stand-in raw tables, and measures over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import surrogate_key
from tidemark.operators import gap_fill
from tidemark.operators.measures import measure
from tidemark.operators.spine import date_spine
from tidemark.plans.build import MODELS, build, publish_table
from tidemark.plans.marts import habits_metrics
from tidemark.plans.semantic import ENGAGEMENT_CONTACTS, HABITS
from tidemark.plans.staging import activities
from tidemark.session import shared_dir, written
from tidemark.sources.csv import read_csv, write_csv
from workload.registry import query
from workload.standins import RAW_SQL, given, raw, raw_for_duckdb


def _latest(source: str, key: str, order: str) -> str:
    return f"{source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


def _page_model(table: str, columns: str, ties: str) -> str:
    return _latest(
        f"""
        SELECT parent__data_source_id AS database_id, id AS page_id,
               CAST(left(json_extract_string(properties__date__date, '$.start'), 10) AS DATE)
                   AS page_date,
               properties__name__title AS page_name, {columns},
               created_time AS created_at, last_edited_time AS updated_at
        FROM {table}""",
        "id",
        f"last_edited_time DESC{ties}",
    )


def _boxes(*flags: str) -> str:
    return ", ".join(f"properties__{f}__checkbox AS did_{f}" for f in flags)


_NULL = "'_dbt_utils_surrogate_key_null_'"


def _unpivoted(table: str, period: str, flags: str) -> str:
    return f"""
        SELECT md5(page_id || '-' || habit) AS row_id, '{period}' AS habit_period, database_id,
               page_id, page_date, page_name, habit, is_complete, created_at, updated_at
        FROM {table} UNPIVOT (is_complete FOR habit IN ({flags}))"""


def _key_rows(table: str, key: str, at: str, period: str, habit: str, done: str) -> str:
    return f"""
        SELECT md5(CAST({key} AS VARCHAR)), CAST({key} AS VARCHAR), {at}, '{period}', {habit},
               {done} FROM {table}"""


_DAILY = "did_devotional, did_journal, did_prayer, did_read_bible, did_workout, did_language"
_WEEKLY = "did_fast, did_church, did_community, did_cook, did_cardio, did_sabbath, did_date_night"
_MONTHLY = "did_budget, did_serve, did_travel, did_blog, did_goal_review, did_training"


def _branch(kind: str, table: str, body: str, at: str) -> str:
    return f"""SELECT id, '{kind}' AS kind, properties__{body} AS body, properties__{at} AS began,
                      created_at, updated_at FROM hubspot__{table}"""


def _link(table: str) -> str:
    return f"""SELECT _hubspot__{table}_id AS engagement_id, to_object_id AS contact_id
               FROM hubspot__{table}_to_contacts"""


# Each model in terms of the ones before it.
MODEL_SQL: dict[str, str] = {
    "stg_hubspot__companies": _latest(
        """
        SELECT id AS company_id, properties__name AS company_name,
               properties__createdate AS created_at,
               properties__hs_lastmodifieddate AS updated_at,
               TRY_CAST(right(properties__hs_ideal_customer_profile, 1) AS INTEGER)
                   AS company_tier
        FROM hubspot__companies""",
        "id",
        "properties__hs_lastmodifieddate DESC, properties__name DESC",
    ),
    "stg_hubspot__contacts": _latest(
        """
        SELECT id AS contact_id, CAST(properties__associatedcompanyid AS BIGINT) AS company_id,
               properties__email AS email, properties__firstname AS first_name,
               properties__lastname AS last_name, properties__createdate AS created_at,
               properties__lastmodifieddate AS updated_at
        FROM hubspot__contacts""",
        "id",
        "properties__lastmodifieddate DESC, properties__firstname DESC",
    ),
    "base_hubspot__engagements": f"""
        SELECT id AS engagement_id, kind AS engagement_type, body AS body_preview,
               began AS occurred_at, created_at, updated_at
        FROM ({_branch("MEETING", "meetings", "hs_meeting_body", "hs_meeting_start_time")}
              UNION ALL {_branch("CALL", "calls", "hs_call_body", "hs_timestamp")}
              UNION ALL
              {_branch("COMMUNICATION", "communications", "hs_communication_body", "hs_timestamp")})
        QUALIFY row_number() OVER (
            PARTITION BY id
            ORDER BY updated_at DESC, kind DESC, body DESC, began DESC, created_at DESC) = 1""",
    "base_hubspot__engagement_contacts": f"""
        SELECT DISTINCT engagement_id, contact_id
        FROM ({_link("meetings")} UNION ALL {_link("calls")} UNION ALL {_link("communications")})
        WHERE engagement_id IS NOT NULL""",
    "stg_hubspot__engagements": """
        SELECT *, engagement_type <> 'COMMUNICATION' AS is_synchronous
        FROM base_hubspot__engagements""",
    "stg_hubspot__engagement_contacts": """
        SELECT md5(CAST(engagement_id AS VARCHAR) || '-' || CAST(contact_id AS VARCHAR)) AS row_id,
               engagement_id, contact_id
        FROM base_hubspot__engagement_contacts""",
    "stg_fitbit__sleep": _latest(
        """
        SELECT log_id, date_of_sleep, duration AS duration_ms,
               duration / 3600000 AS duration_hr, start_time AS started_at,
               end_time AS ended_at, type AS sleep_type, log_type,
               duration >= 25200000 AS sleep_goal_met
        FROM fitbit__sleep""",
        "log_id",
        "date_of_sleep DESC, duration DESC",
    ),
    "stg_fitbit__activities": """
        SELECT CAST(left(start_time, 10) AS DATE) AS date_of_activity,
               CAST(sum(coalesce(steps, 0)) AS BIGINT) AS steps,
               sum(coalesce(steps, 0)) >= 7500 AS steps_goal_met
        FROM (SELECT * FROM fitbit__activities
              QUALIFY row_number() OVER (
                  PARTITION BY log_id
                  ORDER BY last_modified DESC, start_time DESC, steps DESC NULLS LAST) = 1)
        GROUP BY 1""",
    "stg_notion__daily_habits": _page_model(
        "notion__data_source_daily_habits",
        _boxes("devotional", "journal", "prayer", "read_bible", "workout", "language"),
        "",
    ),
    "stg_notion__weekly_habits": _page_model(
        "notion__data_source_weekly_habits",
        _boxes("fast")
        + """, CAST(round(CAST(json_extract_string(
                   properties__prayer_minutes__formula, '$.number') AS DOUBLE)) AS INTEGER)
               AS prayer_minutes,
               CAST(properties__screen_minutes__number AS DOUBLE) AS screen_minutes, """
        + _boxes("church", "community", "cook", "cardio", "sabbath", "date_night"),
        "",
    ),
    "stg_notion__monthly_habits": _page_model(
        "notion__data_source_monthly_habits",
        _boxes("budget", "serve", "travel", "blog", "goal_review", "training"),
        "",
    ),
    "stg_notion__habit_reference": """
        SELECT page_id, habit_name,
               CASE WHEN habit_type = 'tickbox' THEN concat('did_', lower(replace(habit_name, ' ', '_')))
                    WHEN habit_name = 'Meet 1to1' THEN 'met_1to1'
                    WHEN habit_name = 'Meet Group' THEN 'met_group'
                    ELSE lower(replace(habit_name, ' ', '_')) END AS habit_key,
               category, frequency, habit_type, source, target_pct, threshold, below_threshold,
               active, start_date, created_at, updated_at
        FROM (SELECT id AS page_id, properties__name__title AS habit_name,
                     properties__category__select ->> '$.name' AS category,
                     lower(properties__frequency__select ->> '$.name') AS frequency,
                     lower(properties__type__select ->> '$.name') AS habit_type,
                     properties__source__select ->> '$.name' AS source,
                     CAST(properties__target__number AS DOUBLE) / 100 AS target_pct,
                     CAST(properties__threshold__number AS DOUBLE) AS threshold,
                     properties__below_threshold__checkbox AS below_threshold,
                     (properties__active__formula ->> '$.checkbox') = 'true' AS active,
                     CAST(left(properties__start_date__date ->> '$.start', 10) AS DATE)
                         AS start_date,
                     created_time AS created_at, last_edited_time AS updated_at
              FROM notion__data_source_habit_reference
              QUALIFY row_number() OVER (PARTITION BY id ORDER BY last_edited_time DESC) = 1)""",
    "int_habits_unpivoted": f"""
        {_unpivoted("stg_notion__daily_habits", "day", _DAILY)} UNION ALL
        {_unpivoted("stg_notion__weekly_habits", "week", _WEEKLY)} UNION ALL
        {_unpivoted("stg_notion__monthly_habits", "month", _MONTHLY)}""",
    "habits_v1": f"""
        SELECT row_id AS habit_key, page_id AS source_id, page_date AS habit_date, habit_period,
               habit, is_complete
        FROM int_habits_unpivoted
        UNION ALL SELECT md5(page_id || '-prayer_minutes'), page_id, page_date, 'week',
               'prayer_minutes', prayer_minutes IS NOT NULL AND prayer_minutes >= 15
        FROM stg_notion__weekly_habits
        UNION ALL SELECT md5(page_id || '-screen_minutes'), page_id, page_date, 'week',
               'screen_minutes', screen_minutes <= 800
        FROM stg_notion__weekly_habits
        UNION ALL {_key_rows("stg_fitbit__sleep", "log_id", "date_of_sleep", "day", "'sleep_minutes'", "sleep_goal_met")}
        UNION ALL {_key_rows("stg_fitbit__activities", "date_of_activity", "date_of_activity", "day", "'steps'", "steps_goal_met")}
        UNION ALL {_key_rows('''(SELECT engagement_id, occurred_at,
                    (SELECT count(contact_id) FROM stg_hubspot__engagement_contacts l
                     WHERE l.engagement_id = e.engagement_id) AS people
                  FROM stg_hubspot__engagements e WHERE is_synchronous)''',
                  "engagement_id", "CAST(date_trunc('week', occurred_at) AS DATE)", "week",
                  "CASE people WHEN 1 THEN 'met_1to1' ELSE 'met_group' END", "true")}""",
    "habits_metrics_v1": """
        SELECT p.habit, r.habit_name, r.category, r.frequency, r.source, r.habit_type,
               p.period_start, p.report_period, p.total_periods, p.completed_periods,
               round(p.completed_periods / p.total_periods, 4) AS completion_rate,
               r.target_pct,
               round(p.completed_periods / p.total_periods, 4) >= r.target_pct AS target_met,
               r.threshold, r.below_threshold, r.active
        FROM (
            SELECT habit, CAST(date_trunc('week', habit_date) AS DATE) AS period_start,
                   'week' AS report_period, count(is_complete) AS total_periods,
                   count(*) FILTER (WHERE is_complete) AS completed_periods
            FROM habits_v1 WHERE habit_period = 'day' AND is_complete IS NOT NULL GROUP BY ALL
            UNION ALL
            SELECT habit, habit_date, habit_period, 1, CAST(is_complete AS BIGINT)
            FROM habits_v1
            WHERE habit_period IN ('week', 'month') AND NOT starts_with(habit, 'met_')
              AND is_complete IS NOT NULL
            UNION ALL
            SELECT h.habit, h.habit_date, 'week', 1,
                   CASE WHEN h.n >= coalesce(t.threshold, 1) THEN 1 ELSE 0 END
            FROM (SELECT habit, habit_date, count(*) AS n FROM habits_v1
                  WHERE starts_with(habit, 'met_') GROUP BY ALL) h
            LEFT JOIN stg_notion__habit_reference t ON t.habit_key = h.habit
        ) p LEFT JOIN stg_notion__habit_reference r ON r.habit_key = p.habit""",
    "engagement_contacts_v1": f"""
        SELECT md5(concat_ws('-', CAST(e.engagement_id AS VARCHAR),
                             coalesce(CAST(c.contact_id AS VARCHAR), {_NULL}))) AS engagement_key,
               e.engagement_id, e.engagement_type, e.body_preview, e.occurred_at,
               e.is_synchronous, c.contact_id, c.first_name, c.last_name,
               a.company_id, a.company_name, e.updated_at
        FROM stg_hubspot__engagements e
        LEFT JOIN stg_hubspot__engagement_contacts l USING (engagement_id)
        LEFT JOIN stg_hubspot__contacts c ON c.contact_id = l.contact_id
        LEFT JOIN stg_hubspot__companies a ON a.company_id = c.company_id""",
}


def _needed(name: str, found: list[str]) -> list[str]:
    for used in (*RAW_SQL, *MODEL_SQL):
        text = MODEL_SQL.get(name, "")
        if used != name and used in text.replace("(", " ").replace(")", " ").split():
            if used not in found:
                _needed(used, found)
                found.append(used)
    return found


def with_models(select: str, *names: str) -> str:
    """A statement with every model and raw table the named models rest on."""
    found: list[str] = []
    for name in names:
        _needed(name, found)
        if name not in found:
            found.append(name)
    tables = [f"{n} AS ({MODEL_SQL.get(n) or raw_for_duckdb(n)})" for n in found]
    return f"WITH {', '.join(tables)} {select}"


def _sources(name: str) -> set[str]:
    """Raw tables a model rests on."""
    if name in RAW_SQL:
        return {name}
    return set().union(*[_sources(i) for i in MODELS[name].inputs])


def models(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Models over the stand-ins."""
    sources = set().union(*[_sources(n) for n in names])
    return build({n: raw(spark, sf_dir, n) for n in sources}, names)


def _register(name: str) -> None:
    @query(name, with_models(f"SELECT * FROM {name}", name))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return models(spark, sf_dir, name)[name]


for _name in MODEL_SQL:
    _register(_name)


@query(
    "stg_hubspot__engagement_companies",
    with_models(
        """
        SELECT engagement_id, CAST(NULL AS INTEGER) AS company_id FROM stg_hubspot__engagements
        """,
        "stg_hubspot__engagements",
    ),
)
def engagement_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The empty link table, left joined to the engagements."""
    names = ("stg_hubspot__engagements", "stg_hubspot__engagement_companies")
    found = models(spark, sf_dir, *names)
    engagements = found[names[0]].select("engagement_id")
    links = found[names[1]].select("engagement_id", "company_id")
    return engagements.join(links, "engagement_id", "left")


assert {*MODEL_SQL, "stg_hubspot__engagement_companies"} == set(MODELS)


# --- variants that keep what was delivered twice -------------------------------


@query(
    "fitbit_activities_redelivered",
    f"""
    SELECT CAST(left(start_time, 10) AS DATE) AS date_of_activity,
           CAST(sum(coalesce(steps, 0)) AS BIGINT) AS steps,
           sum(coalesce(steps, 0)) >= 7500 AS steps_goal_met
    FROM ({raw_for_duckdb("fitbit__activities")}) GROUP BY 1
    """,
)
def activities_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps per day where each delivery of a log counts."""
    return activities(raw(spark, sf_dir, "fitbit__activities"), dedupe=False)


# --- CSV ---------------------------------------------------------------------

_QUOTED = """ || ' "x, y"' || chr(10) || 'z'"""


@query(
    "csv_round_trip",
    f"""
    WITH logs AS (
        SELECT id, CAST(properties__associatedcompanyid AS BIGINT) AS properties__associatedcompanyid,
               properties__email, properties__firstname{_QUOTED} AS properties__firstname, properties__lastname,
               properties__createdate, properties__lastmodifieddate
        FROM ({raw_for_duckdb("hubspot__contacts")}))
    SELECT 'doubled' AS dialect, * FROM logs UNION ALL SELECT 'backslash', * FROM logs
    """,
)
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table as CSV, with commas, quotes and line feeds in it, in both ways to write quotes."""
    contacts = raw(spark, sf_dir, "hubspot__contacts")
    contacts = contacts.withColumn("properties__firstname", F.expr(f"properties__firstname{_QUOTED}"))
    read = []
    for dialect, escape in (("doubled", '"'), ("backslash", "\\")):
        path = shared_dir(spark, f"csv-{dialect}")
        write_csv(contacts, path, escape)
        table = read_csv(spark, path, "hubspot__contacts", escape)
        read.append(table.select(F.lit(dialect).alias("dialect"), "*"))
    return read[0].unionByName(read[1])


# --- time spine ----------------------------------------------------------------


@query(
    "time_spine_daily",
    with_models(
        """
        , days AS (SELECT CAST(unnest(generate_series(
                       TIMESTAMP '2020-01-01', TIMESTAMP '2030-12-30', INTERVAL 1 DAY)) AS DATE)
                       AS date_day)
        SELECT date_day, coalesce(n, 0) AS total_habits
        FROM days LEFT JOIN (SELECT habit_date, count(*) AS n FROM habits_v1 GROUP BY 1)
             ON habit_date = date_day
        """.lstrip(),
        "habits_v1",
    ),
)
def time_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered spine, filled with the daily number of habit records."""
    habits = models(spark, sf_dir, "habits_v1")["habits_v1"]
    daily = measure(HABITS, habits, ["total_habits"], ["habit_date"])
    return gap_fill(date_spine(spark), daily, "habit_date", ["total_habits"])


@query(
    "measure_habits",
    with_models(
        """
        SELECT habit_period, CAST(date_trunc('month', habit_date) AS DATE) AS habit_date__month,
               habit AS habit_name,
               CAST(sum(CASE WHEN is_complete THEN 1 ELSE 0 END) AS BIGINT) AS habit_completions,
               count(habit_date) AS total_habits,
               round(avg(CASE WHEN is_complete THEN 1.0 ELSE 0.0 END), 9) AS completion_rate
        FROM habits_v1 GROUP BY ALL
        """,
        "habits_v1",
    ),
)
def measure_habits(spark: SparkSession, sf_dir: str) -> DataFrame:
    habits = models(spark, sf_dir, "habits_v1")["habits_v1"]
    names = [m.name for m in HABITS.measures]
    result = measure(HABITS, habits, names, ["habit_period", "habit_date__month", "habit_name"])
    return result.withColumn("completion_rate", F.round("completion_rate", 9))


@query(
    "measure_engagements",
    with_models(
        """
        SELECT company_name, CAST(date_trunc('year', occurred_at) AS DATE) AS engagement_date__year,
               count(DISTINCT engagement_id) AS engagement_count,
               count(DISTINCT CASE WHEN is_synchronous THEN engagement_id END)
                   AS synchronous_engagements,
               count(DISTINCT CASE WHEN NOT is_synchronous THEN engagement_id END)
                   AS asynchronous_engagements,
               count(DISTINCT contact_id) AS contact_count
        FROM engagement_contacts_v1 GROUP BY ALL
        """,
        "engagement_contacts_v1",
    ),
)
def measure_engagements(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = models(spark, sf_dir, "engagement_contacts_v1")["engagement_contacts_v1"]
    names = [m.name for m in ENGAGEMENT_CONTACTS.measures]
    return measure(ENGAGEMENT_CONTACTS, mart, names, ["company_name", "engagement_date__year"])


_ALIGNED_SQL = MODEL_SQL["habits_metrics_v1"].replace(
    "SELECT habit, habit_date, habit_period, 1,",
    "SELECT habit, CASE WHEN habit_period = 'week' THEN CAST(date_trunc('week', habit_date) AS DATE) ELSE habit_date END, habit_period, 1,",
)


@query(
    "habits_metrics_aligned",
    with_models(f"SELECT * FROM ({_ALIGNED_SQL}) aligned", "habits_v1", "stg_notion__habit_reference"),
)
def habits_metrics_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics with weekly pages moved to the Monday of their week."""
    built = models(spark, sf_dir, "habits_v1", "stg_notion__habit_reference")
    return habits_metrics(built["habits_v1"], built["stg_notion__habit_reference"], align_weeks=True)


@query(
    "publish_table",
    """
    SELECT md5(CAST(o_orderkey AS VARCHAR)) AS habit_key, CAST(o_orderdate AS DATE) AS habit_date,
           CASE o_orderstatus WHEN 'F' THEN 'day' ELSE 'week' END AS habit_period, o_orderstatus = 'F' AS is_complete,
           'Hash that identifies the habit record' AS key_comment, 'Day the record counts for' AS date_comment
    FROM orders
    """,
)
def publish_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table in the catalog: its rows and the comments of its columns, as the catalog has them."""
    done = F.col("o_orderstatus") == "F"
    rows = given(spark, sf_dir, "orders").select(
        surrogate_key("o_orderkey").alias("habit_key"), F.col("o_orderdate").cast("date").alias("habit_date"),
        F.when(done, "day").otherwise("week").alias("habit_period"), done.alias("is_complete"),
    )
    folder = shared_dir(spark, "published")
    name = "published_" + folder.rpartition("-")[2]
    table = publish_table(rows, name, folder=folder, partition_by=["habit_period"])
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    commented = table.select(
        "*", F.lit(comments["habit_key"]).alias("key_comment"), F.lit(comments["habit_date"]).alias("date_comment")
    )
    read = written(commented, "published-read")
    spark.sql(f"DROP TABLE {name}")
    return read
