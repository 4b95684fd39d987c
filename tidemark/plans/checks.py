"""The checks every model and source table has to pass.

Column lists, bounds and value lists are fixed values.
"""

from __future__ import annotations

from datetime import date, datetime

from tidemark.operators.quality import (
    Check,
    accepted_values,
    between,
    compound_unique,
    no_overlap,
    not_null,
    relationships,
    unique,
)
from tidemark.sources.schemas import DAILY_FLAGS, MONTHLY_FLAGS, column_names

FIRST = datetime(2020, 1, 1)
LAST = datetime(2030, 12, 31)
FIRST_SLEEP = datetime(2019, 1, 1)
PERIODS = ("day", "week", "month")


def _in_range(*columns: str) -> list[Check]:
    return [c for column in columns for c in between(column, FIRST, LAST)]


def _habit_pages(*flags: str) -> list[Check]:
    return [
        *not_null("page_id", "database_id", "page_date", "page_name", *flags),
        *not_null("created_at", "updated_at"),
        *unique("page_id"),
        *between("page_date", date(2020, 1, 1), date(2030, 12, 31)),
        *_in_range("created_at", "updated_at"),
    ]


_ENGAGEMENT_TIMES = ("occurred_at", "created_at", "updated_at")

MODEL_CHECKS: dict[str, list[Check]] = {
    "stg_hubspot__companies": [
        *unique("company_id"),
        *not_null("company_id", "company_name", "created_at", "updated_at"),
        *between("company_tier", 1, 3, where="company_tier is not null"),
        *_in_range("created_at", "updated_at"),
    ],
    "stg_hubspot__contacts": [
        *unique("contact_id"),
        *not_null("contact_id", "first_name", "last_name", "created_at", "updated_at"),
        *relationships("company_id", "stg_hubspot__companies", "company_id"),
        *_in_range("created_at", "updated_at"),
    ],
    "base_hubspot__engagements": [
        *unique("engagement_id"),
        *not_null("engagement_id", "engagement_type", *_ENGAGEMENT_TIMES),
        *_in_range(*_ENGAGEMENT_TIMES),
    ],
    "stg_hubspot__engagements": [
        *unique("engagement_id"),
        *not_null("engagement_id", "engagement_type", "is_synchronous", *_ENGAGEMENT_TIMES),
        *_in_range(*_ENGAGEMENT_TIMES),
    ],
    "stg_hubspot__engagement_contacts": [
        *unique("row_id"),
        *not_null("row_id"),
        *relationships("engagement_id", "stg_hubspot__engagements", "engagement_id"),
        *relationships("contact_id", "stg_hubspot__contacts", "contact_id"),
    ],
    "stg_hubspot__engagement_companies": [
        *unique("row_id"),
        *not_null("row_id"),
        *relationships("engagement_id", "stg_hubspot__engagements", "engagement_id"),
        *relationships("company_id", "stg_hubspot__companies", "company_id"),
    ],
    "stg_fitbit__sleep": [
        *unique("log_id"),
        *not_null(
            "log_id", "date_of_sleep", "duration_ms", "duration_hr", "started_at", "ended_at",
            "sleep_type", "log_type", "sleep_goal_met",
        ),
        *between("duration_ms", 7_200_000, 43_200_000),
        *between("duration_hr", 2, 12),
        *between("started_at", FIRST_SLEEP, LAST),
        *between("ended_at", FIRST, LAST),
    ],
    "stg_notion__daily_habits": _habit_pages(*[f"did_{f}" for f in DAILY_FLAGS]),
    "stg_notion__weekly_habits": [
        *_habit_pages("did_fast", "did_church", "did_community"),
        *between("prayer_minutes", 0, 30, where="prayer_minutes is not null"),
        *between("screen_minutes", 250, 2000, where="screen_minutes is not null"),
    ],
    "stg_notion__monthly_habits": _habit_pages(*[f"did_{f}" for f in MONTHLY_FLAGS[:4]]),
    "int_habits_unpivoted": [
        *unique("row_id"),
        *not_null(
            "row_id", "habit_period", "page_id", "database_id", "page_date", "page_name",
            "habit", "is_complete", "created_at", "updated_at",
        ),
        *accepted_values("habit_period", PERIODS),
    ],
    "habits_v1": [
        *unique("habit_key"),
        *not_null("habit_key", "habit_date", "habit_period", "habit", "is_complete"),
        *accepted_values("habit_period", PERIODS),
    ],
    "engagement_contacts_v1": [
        *compound_unique("engagement_id", "contact_id"),
        *unique("engagement_key"),
        *not_null(
            "engagement_key", "engagement_id", "engagement_type", "occurred_at", "is_synchronous"
        ),
    ],
}


def _raw_columns(table: str, *optional: str) -> list[str]:
    return [c for c in column_names(table) if c not in optional]


_DAILY = "notion__data_source_daily_habits"
_WEEKLY = "notion__data_source_weekly_habits"
_MONTHLY = "notion__data_source_monthly_habits"
_CRM = ("companies", "contacts", "meetings", "calls", "communications", "deals", "tickets")

SOURCE_CHECKS: dict[str, list[Check]] = {
    **{f"hubspot__{name}": not_null("id") for name in _CRM},
    "fitbit__sleep": [*not_null("log_id"), *no_overlap("start_time", "end_time")],
    "fitbit__activities": not_null("log_id"),
    _DAILY: not_null(*_raw_columns(_DAILY)),
    _WEEKLY: [
        *not_null(
            *_raw_columns(
                _WEEKLY,
                "properties__cook__checkbox",
                "properties__cardio__checkbox",
                "properties__sabbath__checkbox",
                "properties__date_night__checkbox",
                "properties__screen_minutes__number",
            )
        ),
        *between(
            "properties__screen_minutes__number", 250, 2000,
            where="properties__screen_minutes__number is not null",
        ),
    ],
    _MONTHLY: not_null(
        *_raw_columns(
            _MONTHLY, "properties__goal_review__checkbox", "properties__training__checkbox"
        )
    ),
    "notion__data_source_habit_reference": not_null(
        "parent__data_source_id", "id", "properties__name__title"
    ),
}
