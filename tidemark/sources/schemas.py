"""Column names and types of the raw tables, as the models read them.

All names below are fixed values: they follow from the API field names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


_PAGE_HEAD = "parent__data_source_id string, id string, properties__date__date string, properties__name__title string"
_PAGE_TAIL = "created_time timestamp, last_edited_time timestamp"

DAILY_FLAGS = ("devotional", "journal", "prayer", "read_bible", "workout", "language")
WEEKLY_FLAGS = ("fast", "church", "community", "cook", "cardio", "sabbath", "date_night")
MONTHLY_FLAGS = ("budget", "serve", "travel", "blog", "goal_review", "training")


def _checkboxes(flags: tuple[str, ...]) -> str:
    return ", ".join(f"properties__{f}__checkbox boolean" for f in flags)


RAW_TABLES: dict[str, str] = {
    "hubspot__companies": (
        "id bigint, properties__name string, properties__createdate timestamp, "
        "properties__hs_lastmodifieddate timestamp, properties__hs_ideal_customer_profile string"
    ),
    "hubspot__contacts": (
        "id bigint, properties__associatedcompanyid bigint, properties__email string, "
        "properties__firstname string, properties__lastname string, "
        "properties__createdate timestamp, properties__lastmodifieddate timestamp"
    ),
    "hubspot__meetings": (
        "id bigint, properties__hs_meeting_body string, "
        "properties__hs_meeting_start_time timestamp, created_at timestamp, updated_at timestamp"
    ),
    "hubspot__calls": (
        "id bigint, properties__hs_call_body string, properties__hs_timestamp timestamp, "
        "created_at timestamp, updated_at timestamp"
    ),
    "hubspot__communications": (
        "id bigint, properties__hs_communication_body string, "
        "properties__hs_timestamp timestamp, created_at timestamp, updated_at timestamp"
    ),
    "hubspot__meetings_to_contacts": (
        "to_object_id bigint, _hubspot__meetings_id bigint, "
        "_hubspot__meetings_updated_at timestamp"
    ),
    "hubspot__calls_to_contacts": (
        "to_object_id bigint, _hubspot__calls_id bigint, _hubspot__calls_updated_at timestamp"
    ),
    "hubspot__communications_to_contacts": (
        "to_object_id bigint, _hubspot__communications_id bigint, "
        "_hubspot__communications_updated_at timestamp"
    ),
    "fitbit__sleep": (
        "log_id bigint, date_of_sleep date, duration bigint, start_time timestamp, "
        "end_time timestamp, type string, log_type string"
    ),
    "fitbit__activities": (
        "log_id bigint, start_time string, steps bigint, last_modified timestamp"
    ),
    "notion__data_source_daily_habits": (
        f"{_PAGE_HEAD}, {_checkboxes(DAILY_FLAGS)}, {_PAGE_TAIL}"
    ),
    "notion__data_source_weekly_habits": (
        f"{_PAGE_HEAD}, {_checkboxes(WEEKLY_FLAGS)}, properties__prayer_minutes__formula string, "
        f"properties__screen_minutes__number decimal(38,9), {_PAGE_TAIL}"
    ),
    "notion__data_source_monthly_habits": (
        f"{_PAGE_HEAD}, {_checkboxes(MONTHLY_FLAGS)}, {_PAGE_TAIL}"
    ),
    "notion__data_source_habit_reference": (
        "parent__data_source_id string, id string, properties__name__title string, "
        "properties__category__select string, properties__frequency__select string, "
        "properties__type__select string, properties__source__select string, "
        "properties__target__number decimal(38,9), properties__threshold__number decimal(38,9), "
        "properties__below_threshold__checkbox boolean, properties__active__formula string, "
        f"properties__start_date__date string, {_PAGE_TAIL}"
    ),
}


def columns_of(table: str) -> list[tuple[str, str]]:
    """Name and type of each column of a raw table, without a session to parse them."""
    return [tuple(column.split(" ", 1)) for column in RAW_TABLES[table].split(", ")]


def column_names(table: str) -> list[str]:
    return [name for name, _ in columns_of(table)]


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of a raw table; columns it lacks are null."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"cast({name if name in have else 'null'} as {kind}) as {name}"
            for name, kind in columns_of(table)
        ]
    )
