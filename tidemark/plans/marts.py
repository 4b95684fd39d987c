"""Intermediate and mart models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import completion_rate, surrogate_key, trunc_date
from tidemark.operators import (
    child_counts,
    ALL,
    frequent_keys,
    left_join_hot_right,
    spread_join,
    union_all,
    union_by_name,
    unpivot_flags,
)
from tidemark.sources.schemas import DAILY_FLAGS, MONTHLY_FLAGS, WEEKLY_FLAGS

# Minutes a week that count as done.
PRAYER_MINUTES_MIN = 15
SCREEN_MINUTES_MAX = 800

MEETING_HABITS = ("met_1to1", "met_group")
_HABIT_COLUMNS = ("habit_key", "source_id", "habit_date", "habit_period", "habit", "is_complete")


def _flag_rows(
    pages: DataFrame, period: str, flags: Sequence[str], keep_null: Sequence[str] = ()
) -> DataFrame:
    ids = ["database_id", "page_id", "page_date", "page_name", "created_at", "updated_at"]
    rows = unpivot_flags(
        pages.select(*ids, *flags), ids, flags, "habit", "is_complete", keep_null
    )
    return rows.select(
        surrogate_key("page_id", "habit").alias("row_id"),
        F.lit(period).alias("habit_period"),
        *ids[:4],
        "habit",
        "is_complete",
        *ids[4:],
    )


def _did(flags: Sequence[str]) -> list[str]:
    return [f"did_{f}" for f in flags]


def habits_unpivoted(daily: DataFrame, weekly: DataFrame, monthly: DataFrame) -> DataFrame:
    """Tick boxes of all habit pages, one row per page and habit."""
    return union_by_name(
        _flag_rows(daily, "day", _did(DAILY_FLAGS)),
        _flag_rows(weekly, "week", _did(WEEKLY_FLAGS)),
        _flag_rows(monthly, "month", _did(MONTHLY_FLAGS)),
    )


def _page_habits(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("row_id").alias("habit_key"),
        F.col("page_id").alias("source_id"),
        F.col("page_date").alias("habit_date"),
        "habit_period",
        "habit",
        "is_complete",
    )


def _single_key_habits(rows: DataFrame, key: str, date, period: str, habit, done) -> DataFrame:
    return rows.select(
        surrogate_key(key).alias("habit_key"),
        F.col(key).cast("string").alias("source_id"),
        date.alias("habit_date"),
        F.lit(period).alias("habit_period"),
        habit.alias("habit"),
        done.alias("is_complete"),
    )


def habits(
    daily: DataFrame,
    weekly: DataFrame,
    monthly: DataFrame,
    sleep: DataFrame,
    activities: DataFrame,
    engagements: DataFrame,
    engagement_contacts: DataFrame,
    prayer_min: int = PRAYER_MINUTES_MIN,
    screen_max: int = SCREEN_MINUTES_MAX,
) -> DataFrame:
    """Every habit record: tick boxes, weekly minutes, sleep, steps and meetings.

    The weekly pages are read once: the two minute counts become flags beside the
    tick boxes and are unpivoted with them (their key, page and habit name, is the
    same). Missing screen minutes stay as a null flag, missing tick boxes vanish.
    """
    weekly_flags = weekly.withColumn(
        "prayer_minutes", F.coalesce("prayer_minutes", F.lit(0)) >= prayer_min
    ).withColumn("screen_minutes", F.col("screen_minutes") <= screen_max)
    numbers = ["prayer_minutes", "screen_minutes"]

    meetings = child_counts(
        engagements.filter("is_synchronous").select("engagement_id", "occurred_at"),
        engagement_contacts,
        "engagement_id",
        "contact_id",
        "contact_count",
    )
    one_to_one = F.when(F.col("contact_count") == 1, "met_1to1").otherwise("met_group")
    return union_all(
        _page_habits(_flag_rows(daily, "day", _did(DAILY_FLAGS))),
        _page_habits(
            _flag_rows(
                weekly_flags, "week", _did(WEEKLY_FLAGS) + numbers, keep_null=["screen_minutes"]
            )
        ),
        _page_habits(_flag_rows(monthly, "month", _did(MONTHLY_FLAGS))),
        _single_key_habits(
            sleep, "log_id", F.col("date_of_sleep"), "day",
            F.lit("sleep_minutes"), F.col("sleep_goal_met"),
        ),
        _single_key_habits(
            activities, "date_of_activity", F.col("date_of_activity"), "day",
            F.lit("steps"), F.col("steps_goal_met"),
        ),
        _single_key_habits(
            meetings, "engagement_id", trunc_date("week", "occurred_at"), "week",
            one_to_one, F.lit(True),
        ),
    )


def habits_metrics(
    habits: DataFrame, reference: DataFrame, align_weeks: bool = False
) -> DataFrame:
    """Completion per habit and reporting period against its target.

    Daily habits are counted by week, meetings are counted by week and compared
    with their threshold, weekly and monthly records count for themselves.
    ``align_weeks`` moves weekly records to the Monday of their week.
    """
    known = habits.filter(F.col("is_complete").isNotNull())
    done = F.when(F.col("is_complete"), 1).otherwise(0)
    # Written as comparisons, not as a list, so that Spark can see that no meeting
    # passes the second one and leaves the meetings out of that branch.
    one_to_one, group = MEETING_HABITS
    is_meeting = (F.col("habit") == one_to_one) | (F.col("habit") == group)
    no_meeting = (F.col("habit") != one_to_one) & (F.col("habit") != group)

    by_week = (
        known.filter(F.col("habit_period") == "day")
        .groupBy("habit", trunc_date("week", "habit_date").alias("period_start"))
        .agg(
            F.count("*").alias("total_periods"),
            F.sum(done).cast("bigint").alias("completed_periods"),
        )
        .withColumn("report_period", F.lit("week"))
    )

    def single(rows: DataFrame, start, period: str) -> DataFrame:
        return rows.select(
            "habit",
            start.alias("period_start"),
            F.lit(1).cast("bigint").alias("total_periods"),
            done.cast("bigint").alias("completed_periods"),
            F.lit(period).alias("report_period"),
        )

    week_start = trunc_date("week", "habit_date") if align_weeks else F.col("habit_date")
    weekly_rows = known.filter((F.col("habit_period") == "week") & no_meeting)
    weekly = single(weekly_rows, week_start, "week")
    monthly = single(known.filter(F.col("habit_period") == "month"), F.col("habit_date"), "month")

    thresholds = reference.select(F.col("habit_key").alias("habit"), "threshold")
    enough = F.col("meetings") >= F.coalesce(F.col("threshold"), F.lit(1))
    meetings = (
        known.filter(is_meeting)
        .groupBy("habit", F.col("habit_date").alias("period_start"))
        .agg(F.count("*").alias("meetings"))
        .join(thresholds, "habit", "left")
        .select(
            "habit",
            "period_start",
            F.lit(1).cast("bigint").alias("total_periods"),
            F.when(enough, 1).otherwise(0).cast("bigint").alias("completed_periods"),
            F.lit("week").alias("report_period"),
        )
    )

    periods = union_by_name(by_week, weekly, meetings, monthly)
    targets = reference.select(
        F.col("habit_key").alias("habit"),
        "habit_name", "category", "frequency", "source", "habit_type",
        "target_pct", "threshold", "below_threshold", "active",
    )
    rate = completion_rate("completed_periods", "total_periods")
    # There are few habits, so each is a frequent key should the targets not be broadcast.
    return (
        spread_join(periods.withColumn("completion_rate", rate), targets, ["habit"], frequent=ALL)
        .select(
            "habit", "habit_name", "category", "frequency", "source", "habit_type",
            "period_start", "report_period", "total_periods", "completed_periods",
            "completion_rate", "target_pct",
            (F.col("completion_rate") >= F.col("target_pct")).alias("target_met"),
            "threshold", "below_threshold", "active",
        )
    )


def engagement_contacts(
    engagements: DataFrame, links: DataFrame, contacts: DataFrame, companies: DataFrame
) -> DataFrame:
    """Engagements with their contacts and the contacts' companies.

    A company may have very many contacts, a contact very many engagements and an
    engagement very many contacts; such keys are found by two passes over the keys
    when this is called, and spread in the joins. Ids in the
    result come from the contact and the company, so they are null for a link to an
    unknown contact and for a contact of an unknown company.
    """
    known_companies = companies.select(
        "company_id", F.col("company_id").alias("known_company_id"), "company_name"
    )
    employers = frequent_keys(contacts, ["company_id"])[0]
    people = spread_join(
        contacts.select("contact_id", "company_id", "first_name", "last_name"),
        known_companies,
        ["company_id"],
        frequent=employers,
    )
    people = people.select(
        "contact_id",
        F.col("contact_id").alias("known_contact_id"),
        "first_name",
        "last_name",
        F.col("known_company_id").alias("company_id"),
        "company_name",
    )
    often_met, crowded = frequent_keys(links, ["contact_id"], ["engagement_id"])
    links = links.select("engagement_id", "contact_id")
    widened = spread_join(links, people, ["contact_id"], frequent=often_met)
    widened = widened.drop("contact_id").withColumnRenamed("known_contact_id", "contact_id")
    events = engagements.select(
        "engagement_id", "engagement_type", "body_preview", "occurred_at", "is_synchronous",
        "updated_at",
    )
    joined = left_join_hot_right(events, widened, ["engagement_id"], crowded)
    return joined.select(
        surrogate_key("engagement_id", "contact_id").alias("engagement_key"),
        "engagement_id", "engagement_type", "body_preview", "occurred_at", "is_synchronous",
        "contact_id", "first_name", "last_name", "company_id", "company_name", "updated_at",
    )
