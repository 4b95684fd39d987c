"""The record streams that are landed: fields, cursor, key and handling of each."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Property list of each CRM object.
CRM_PROPERTIES: dict[str, tuple[str, ...]] = {
    "contacts": ("updatedAt", "email", "associatedcompanyid", "firstname", "lastname"),
    "companies": ("updatedAt", "name", "hs_ideal_customer_profile"),
    "meetings": (
        "hs_meeting_start_time", "hs_meeting_end_time", "hs_meeting_title", "hs_meeting_body",
        "hs_internal_meeting_notes", "hs_meeting_location_type", "hs_meeting_outcome",
        "hs_meeting_source", "hs_engagement_source",
    ),
    "calls": (
        "hs_timestamp", "hs_call_body", "hs_call_direction", "hs_call_duration",
        "hs_call_disposition", "hs_call_source", "hs_call_status", "hs_call_title",
        "hs_engagement_source",
    ),
    "communications": (
        "hs_timestamp", "hs_communication_channel_type", "hs_communication_body",
        "hs_engagement_source",
    ),
    "tasks": (
        "hs_task_body", "hs_task_status", "hs_task_priority", "hs_task_parent_task_id",
        "hs_task_for_object_type", "hs_task_family", "hs_task_completion_date",
        "hs_start_date", "hs_engagement_source",
    ),
    "notes": ("hs_note_body", "hs_engagement_source"),
    "deals": (
        "dealname", "dealstage", "pipeline", "dealtype", "amount", "deal_currency_code",
        "createdate", "closedate", "hs_forecast_probability", "hs_deal_stage_probability",
        "closed_lost_reason", "closed_won_reason", "hs_lastmodifieddate",
    ),
    "tickets": (
        "subject", "content", "hs_ticket_priority", "hs_pipeline", "hs_pipeline_stage",
        "hs_ticket_category", "hs_resolution", "hs_engagement_source",
    ),
}

# Properties the CRM sends with each object unasked.
CRM_ALWAYS_SENT: dict[str, tuple[str, ...]] = {
    "contacts": ("createdate", "hs_object_id", "lastmodifieddate"),
    "companies": ("createdate", "hs_object_id", "hs_lastmodifieddate"),
    "deals": ("hs_object_id", "hs_is_closed", "hs_is_closed_won"),
}
CRM_ALWAYS_SENT_OTHERS = ("hs_createdate", "hs_object_id", "hs_lastmodifieddate")

# Objects whose links to contacts are landed too.
CRM_LINKED = ("meetings", "calls", "communications", "tasks", "notes", "deals", "tickets")

# Bookkeeping fields dropped from pages of the notes source.
NOTES_EXCLUDED = (
    "$..object",
    "$..type",
    "$.properties.*.id",
    "$.properties.*.has_more",
    "$.properties..annotations",
)

# Table name of each known data source id.
NOTES_TABLES = {
    "17b04335-b725-4511-ae86-594ef725706c": "daily_habits",
    "3042e681-b85e-494e-b287-9aa80827cd81": "weekly_habits",
    "18f09eb8-3f76-809f-8140-000bbccd5616": "monthly_habits",
    "2ec09eb8-3f76-80de-85f4-000b2cd39a1f": "habit_reference",
}

_TIMES = (
    "createdate", "lastmodifieddate", "hs_createdate", "hs_lastmodifieddate", "hs_timestamp",
    "hs_meeting_start_time", "hs_meeting_end_time",
)

_CRM_RECORD = (
    "id string, createdAt string, updatedAt string, archived boolean, archivedAt string, "
    "url string, propertiesWithHistory string, objectWriteTraceId string, properties string"
)
_RICH_TEXT = (
    "array<struct<type: string, text: struct<content: string, link: string>, "
    "annotations: struct<bold: boolean, italic: boolean, strikethrough: boolean, "
    "underline: boolean, code: boolean, color: string>, plain_text: string, href: string>>"
)
_OPTIONS = (
    "array<struct<hidden: boolean, displayOrder: bigint, description: string, label: string, "
    "value: string>>"
)


@dataclass(frozen=True)
class Resource:
    """``record`` is a DDL schema of the fields whose types are fixed, or None.

    Fields that pages hold beside these are found in them and kept, with the type
    they have there. ``transform`` is a hook on the records, after pruning and
    before flattening; it keeps the bookkeeping columns, whose names begin with an
    underscore, and the cursor. ``cursor`` names the record field that orders changes, ``cursor_type`` its
    type. The two flags say whether the bounds of a date window belong to it.
    """

    name: str
    selector: str
    record: str | None
    cursor: str | None = None
    cursor_type: str = "timestamp"
    include_start: bool = True
    include_end: bool = True
    disposition: str = "append"
    keys: tuple[str, ...] = ()
    properties: tuple[str, ...] | None = None
    casts: Mapping[str, str] = field(default_factory=dict)
    exclude: tuple[str, ...] = ()
    json_columns: tuple[str, ...] = ()
    max_nesting: int = 1000
    route_column: str | None = None
    routes: Mapping[str, str] = field(default_factory=dict)
    route_prefix: str = ""
    parent: str | None = None
    table: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None

    @property
    def target(self) -> str:
        return self.table or self.name


def _crm_object(name: str) -> Resource:
    sent = CRM_PROPERTIES[name] + CRM_ALWAYS_SENT.get(name, CRM_ALWAYS_SENT_OTHERS)
    properties = tuple(dict.fromkeys(sent))
    casts = {f"properties__{p}": "timestamp" for p in properties if p in _TIMES}
    if "associatedcompanyid" in properties:
        casts["properties__associatedcompanyid"] = "bigint"
    return Resource(
        name=f"hubspot__{name}",
        selector="results",
        record=_CRM_RECORD,
        cursor="updatedAt",
        properties=properties,
        casts={"id": "bigint", "created_at": "timestamp", "archived_at": "timestamp", **casts},
    )


def _crm_schema(name: str) -> Resource:
    """Schema documents of all objects share one table, one row per schema id."""
    return Resource(
        name=f"hubspot__schemas_{name}",
        selector="$",
        record=(
            "id string, name string, objectTypeId string, fullyQualifiedName string, "
            "description string, archived boolean, createdAt string, updatedAt string, "
            "createdByUserId bigint, updatedByUserId bigint, primaryDisplayProperty string, "
            "labels struct<singular: string, plural: string>, requiredProperties string, "
            "searchableProperties string, secondaryDisplayProperties array<string>, "
            "associations array<struct<id: string, name: string, fromObjectTypeId: string, "
            "toObjectTypeId: string, createdAt: string, updatedAt: string>>, "
            "properties array<struct<name: string, label: string, type: string, "
            "fieldType: string, groupName: string, description: string, displayOrder: bigint, "
            "hidden: boolean, archived: boolean, hasUniqueValue: boolean, calculated: boolean, "
            "externalOptions: boolean, formField: boolean, hubspotDefined: boolean, "
            "showCurrencySymbol: boolean, calculationFormula: string, dataSensitivity: string, "
            "sensitiveDataCategories: string, referencedObjectType: string, "
            "createdAt: string, updatedAt: string, archivedAt: string, createdUserId: string, "
            f"updatedUserId: string, options: {_OPTIONS}, modificationMetadata: "
            "struct<readOnlyOptions: boolean, readOnlyValue: boolean, "
            "readOnlyDefinition: boolean, archivable: boolean>>>"
        ),
        disposition="merge",
        keys=("id",),
        json_columns=(
            "required_properties", "searchable_properties", "secondary_display_properties",
        ),
        max_nesting=1,
        casts={"created_at": "timestamp", "updated_at": "timestamp"},
        table="hubspot__schemas",
    )


def _crm_link(name: str) -> Resource:
    """Links of an object to contacts; each page carries the parent's key fields."""
    parent = f"hubspot__{name}"
    return Resource(
        name=f"{parent}_to_contacts",
        selector="results",
        record="toObjectId bigint, associationTypes string",
        cursor="updatedAt",
        json_columns=("association_types",),
        max_nesting=1,
        casts={f"_{parent}_id": "bigint"},
        parent=parent,
    )


SLEEP = Resource(
    name="fitbit__sleep",
    selector="sleep",
    record=(
        "dateOfSleep string, duration bigint, efficiency int, startTime string, endTime string, "
        "infoCode int, isMainSleep boolean, levels struct<data: string, summary: string>, "
        "logId bigint, minutesAfterWakeup int, minutesAwake int, minutesAsleep int, "
        "minutesToFallAsleep int, logType string, timeInBed int, type string"
    ),
    cursor="dateOfSleep",
    cursor_type="date",
    include_start=False,
    include_end=False,
    max_nesting=1,
    casts={"start_time": "timestamp", "end_time": "timestamp"},
)

ACTIVITIES = Resource(
    name="fitbit__activities",
    selector="activities",
    record=(
        "activityLevel string, logId bigint, activityTypeId bigint, activityName string, "
        "calories bigint, distance double, steps bigint, speed double, pace double, "
        "duration bigint, activeDuration bigint, distanceUnit string, source struct<type: string, "
        "name: string, id: string, url: string, trackerFeatures: string>, logType string, "
        "manualValuesSpecified struct<calories: boolean, distance: boolean, steps: boolean>, "
        "intervalWorkoutData struct<intervalSummaries: string, numRepeats: bigint>, "
        "activeZoneMinutes struct<totalMinutes: bigint, minutesInHeartRateZones: string>, "
        "inProgress boolean, caloriesLink string, lastModified string, startTime string, "
        "originalStartTime string, originalDuration bigint, elevationGain double, "
        "hasActiveZoneMinutes boolean"
    ),
    cursor="lastModified",
    include_start=False,
    include_end=False,
    json_columns=("activity_level",),
    max_nesting=1,
)

DATA_SOURCES = Resource(
    name="notion__data_sources",
    selector="results",
    record=(
        "object string, id string, created_time string, last_edited_time string, "
        "parent struct<type: string, page_id: string, database_id: string>, archived boolean, "
        f"title {_RICH_TEXT}, description {_RICH_TEXT}, url string, properties string"
    ),
    exclude=(*NOTES_EXCLUDED, "$.properties"),
    json_columns=("title", "description"),
    max_nesting=1,
    casts={"created_time": "timestamp", "last_edited_time": "timestamp"},
)

def notes_rows(tables: Mapping[str, str] = NOTES_TABLES) -> Resource:
    """Pages of the data sources of a workspace, whose ids ``tables`` names; others keep their id as name.

    Users name the properties of their pages, so no field is declared.
    """
    return Resource(
        name="notion__data_source_rows",
        selector="results",
        record=None,
        cursor="last_edited_time",
        include_start=False,
        include_end=False,
        exclude=NOTES_EXCLUDED,
        json_columns=("title",),
        max_nesting=2,
        casts={"created_time": "timestamp"},
        route_column="parent__data_source_id",
        routes=tables,
        route_prefix="notion__data_source_",
    )


DATA_SOURCE_ROWS = notes_rows()

RESOURCES: dict[str, Resource] = {
    r.name: r
    for r in (
        *[_crm_schema(n) for n in CRM_PROPERTIES],
        *[_crm_object(n) for n in CRM_PROPERTIES],
        *[_crm_link(n) for n in CRM_LINKED],
        SLEEP,
        ACTIVITIES,
        DATA_SOURCES,
        DATA_SOURCE_ROWS,
    )
}
