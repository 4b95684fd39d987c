"""Staging models: one clean frame per source table.

Every function takes raw tables (see ``sources.schemas.RAW_TABLES``) and returns
a lazy frame. ``dedupe=False`` on a model that has it keeps re-delivered rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    date_prefix,
    int_from_text,
    json_value,
    last_char_as_int,
    snake_key,
    surrogate_key,
)
from tidemark.operators import empty_relation, latest_per_key, union_all
from tidemark.sources.schemas import DAILY_FLAGS, MONTHLY_FLAGS, WEEKLY_FLAGS, conform

# Goals a day is measured against.
SLEEP_GOAL_MS = 25_200_000
STEPS_GOAL = 7_500

MS_PER_HOUR = 3_600_000
SYNCHRONOUS = ("MEETING", "CALL")


# --- CRM -------------------------------------------------------------------


def companies(raw: DataFrame) -> DataFrame:
    tier = last_char_as_int("properties__hs_ideal_customer_profile")
    clean = conform(raw, "hubspot__companies").select(
        F.col("id").alias("company_id"),
        F.col("properties__name").alias("company_name"),
        F.col("properties__createdate").alias("created_at"),
        F.col("properties__hs_lastmodifieddate").alias("updated_at"),
        tier.alias("company_tier"),
    )
    return latest_per_key(clean, ["company_id"], ["updated_at"])


def contacts(raw: DataFrame) -> DataFrame:
    clean = conform(raw, "hubspot__contacts").select(
        F.col("id").alias("contact_id"),
        F.col("properties__associatedcompanyid").alias("company_id"),
        F.col("properties__email").alias("email"),
        F.col("properties__firstname").alias("first_name"),
        F.col("properties__lastname").alias("last_name"),
        F.col("properties__createdate").alias("created_at"),
        F.col("properties__lastmodifieddate").alias("updated_at"),
    )
    return latest_per_key(clean, ["contact_id"], ["updated_at"])


def _engagement_branch(raw: DataFrame, table: str, kind: str, body: str, at: str) -> DataFrame:
    return conform(raw, table).select(
        F.col("id").alias("engagement_id"),
        F.lit(kind).alias("engagement_type"),
        F.col(body).alias("body_preview"),
        F.col(at).alias("occurred_at"),
        "created_at",
        "updated_at",
    )


def base_engagements(
    meetings: DataFrame, calls: DataFrame, communications: DataFrame
) -> DataFrame:
    """All engagements, latest version per id over the three types."""
    stacked = union_all(
        _engagement_branch(
            meetings, "hubspot__meetings", "MEETING",
            "properties__hs_meeting_body", "properties__hs_meeting_start_time",
        ),
        _engagement_branch(
            calls, "hubspot__calls", "CALL",
            "properties__hs_call_body", "properties__hs_timestamp",
        ),
        _engagement_branch(
            communications, "hubspot__communications", "COMMUNICATION",
            "properties__hs_communication_body", "properties__hs_timestamp",
        ),
    )
    return latest_per_key(stacked, ["engagement_id"], ["updated_at"])


def base_engagement_contacts(
    meetings: DataFrame, calls: DataFrame, communications: DataFrame, dedupe: bool = True
) -> DataFrame:
    """Engagement to contact links; links without an engagement id are dropped."""
    branches = []
    for kind, raw in (("meetings", meetings), ("calls", calls), ("communications", communications)):
        links = conform(raw, f"hubspot__{kind}_to_contacts").select(
            F.col(f"_hubspot__{kind}_id").alias("engagement_id"),
            F.col("to_object_id").alias("contact_id"),
        )
        branches.append(links.filter(F.col("engagement_id").isNotNull()))
    links = union_all(*branches)
    return links.distinct() if dedupe else links


def engagements(base: DataFrame) -> DataFrame:
    """Engagements with the flag for live contact (meetings and calls)."""
    return base.withColumn("is_synchronous", F.col("engagement_type").isin(*SYNCHRONOUS))


def engagement_contacts(base: DataFrame) -> DataFrame:
    key = surrogate_key("engagement_id", "contact_id").alias("row_id")
    return base.select(key, "engagement_id", "contact_id")


def engagement_companies(like: DataFrame) -> DataFrame:
    """Links to companies are not landed: no rows, right columns."""
    return empty_relation(like.sparkSession, "row_id string, engagement_id int, company_id int")


# --- fitness tracker -------------------------------------------------------


def sleep(raw: DataFrame, goal_ms: int = SLEEP_GOAL_MS) -> DataFrame:
    clean = conform(raw, "fitbit__sleep").select(
        "log_id",
        "date_of_sleep",
        F.col("duration").alias("duration_ms"),
        (F.col("duration") / MS_PER_HOUR).alias("duration_hr"),
        F.col("start_time").alias("started_at"),
        F.col("end_time").alias("ended_at"),
        F.col("type").alias("sleep_type"),
        "log_type",
        (F.col("duration") >= goal_ms).alias("sleep_goal_met"),
    )
    return latest_per_key(clean, ["log_id"], ["date_of_sleep"])


def activities(raw: DataFrame, goal: int = STEPS_GOAL, dedupe: bool = True) -> DataFrame:
    """Steps per day, by the date as written in the start time."""
    logs = conform(raw, "fitbit__activities")
    if dedupe:
        logs = latest_per_key(logs, ["log_id"], ["last_modified"])
    daily = logs.groupBy(date_prefix("start_time").alias("date_of_activity")).agg(
        F.sum(F.coalesce("steps", F.lit(0))).alias("steps")
    )
    return daily.withColumn("steps_goal_met", F.col("steps") >= goal)


# --- habit pages -----------------------------------------------------------


def _page_date() -> Column:
    return date_prefix(json_value("properties__date__date", "$.start"))


def _habit_pages(
    raw: DataFrame, table: str, flags: tuple[str, ...], extra: list[Column]
) -> DataFrame:
    pages = conform(raw, table).select(
        F.col("parent__data_source_id").alias("database_id"),
        F.col("id").alias("page_id"),
        _page_date().alias("page_date"),
        F.col("properties__name__title").alias("page_name"),
        *[F.col(f"properties__{f}__checkbox").alias(f"did_{f}") for f in flags],
        *extra,
        F.col("created_time").alias("created_at"),
        F.col("last_edited_time").alias("updated_at"),
    )
    return latest_per_key(pages, ["page_id"], ["updated_at"])


def daily_habits(raw: DataFrame) -> DataFrame:
    return _habit_pages(raw, "notion__data_source_daily_habits", DAILY_FLAGS, [])


def weekly_habits(raw: DataFrame) -> DataFrame:
    prayer = json_value("properties__prayer_minutes__formula", "$.number")
    extra = [
        int_from_text(prayer).alias("prayer_minutes"),
        F.col("properties__screen_minutes__number").alias("screen_minutes"),
    ]
    return _habit_pages(raw, "notion__data_source_weekly_habits", WEEKLY_FLAGS, extra)


def monthly_habits(raw: DataFrame) -> DataFrame:
    return _habit_pages(raw, "notion__data_source_monthly_habits", MONTHLY_FLAGS, [])


def habit_reference(raw: DataFrame, dedupe: bool = True) -> DataFrame:
    """One row per tracked habit with its target.

    ``habit_key`` here is the habit's name as the marts spell it (``did_prayer``);
    in the habits mart a column of the same name is the row's hash.
    """
    rows = conform(raw, "notion__data_source_habit_reference")
    if dedupe:
        rows = latest_per_key(rows, ["id"], ["last_edited_time"])
    kind = F.lower(json_value("properties__type__select", "$.name"))
    name = F.col("properties__name__title")
    is_meeting = name.isin("Meet 1to1", "Meet Group")
    met = F.concat(F.lit("met_"), snake_key(F.replace(name, F.lit("Meet "), F.lit(""))))
    habit_key = (
        F.when(kind == "tickbox", F.concat(F.lit("did_"), snake_key(name)))
        .when(is_meeting, met)
        .otherwise(snake_key(name))
    )
    active = json_value("properties__active__formula", "$.checkbox") == "true"
    return rows.select(
        F.col("id").alias("page_id"),
        name.alias("habit_name"),
        habit_key.alias("habit_key"),
        json_value("properties__category__select", "$.name").alias("category"),
        F.lower(json_value("properties__frequency__select", "$.name")).alias("frequency"),
        kind.alias("habit_type"),
        json_value("properties__source__select", "$.name").alias("source"),
        # A target of 80 means 80 %.
        (F.col("properties__target__number").cast("double") / 100).alias("target_pct"),
        F.col("properties__threshold__number").alias("threshold"),
        F.col("properties__below_threshold__checkbox").alias("below_threshold"),
        active.alias("active"),
        date_prefix(json_value("properties__start_date__date", "$.start")).alias("start_date"),
        F.col("created_time").alias("created_at"),
        F.col("last_edited_time").alias("updated_at"),
    )
