"""Measures and dimensions of the two marts."""

from __future__ import annotations

from tidemark.operators.measures import Dimension, Entity, Measure, SemanticModel

HABITS = SemanticModel(
    name="habits",
    entities=(Entity("habit_record", "habit_key", primary=True),),
    dimensions=(
        Dimension("habit_date", "habit_date", is_time=True),
        Dimension("habit_period", "habit_period"),
        Dimension("habit_name", "habit"),
    ),
    measures=(
        Measure("habit_completions", "sum", "if(is_complete, 1, 0)"),
        Measure("total_habits", "count", "habit_date"),
        Measure("completion_rate", "average", "if(is_complete, 1D, 0D)"),
    ),
)

ENGAGEMENT_CONTACTS = SemanticModel(
    name="engagement_contacts",
    entities=(
        Entity("engagement_contact", "engagement_key", primary=True),
        Entity("engagement", "engagement_id"),
        Entity("contact", "contact_id"),
        Entity("company", "company_id"),
    ),
    dimensions=(
        Dimension("engagement_date", "cast(occurred_at as date)", is_time=True),
        Dimension("engagement_type", "engagement_type"),
        Dimension("is_synchronous", "if(is_synchronous, 'synchronous', 'asynchronous')"),
        Dimension("contact_first_name", "first_name"),
        Dimension("contact_last_name", "last_name"),
        Dimension("company_name", "company_name"),
    ),
    measures=(
        Measure("engagement_count", "count_distinct", "engagement_id"),
        Measure(
            "synchronous_engagements", "count_distinct", "engagement_id", where="is_synchronous"
        ),
        Measure(
            "asynchronous_engagements",
            "count_distinct",
            "engagement_id",
            where="not is_synchronous",
        ),
        Measure("contact_count", "count_distinct", "contact_id"),
    ),
)

SEMANTIC_MODELS = {m.name: m for m in (HABITS, ENGAGEMENT_CONTACTS)}
