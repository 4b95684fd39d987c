from __future__ import annotations

import hashlib
import json
from datetime import date, datetime

import pytest
from conftest import plan, rows
from fixtures import fit, page, raw_frames, reference
from pyspark.sql import functions as F

from tidemark.operators.measures import measure
from tidemark.plans import marts, staging
from tidemark.plans.build import (
    MODELS,
    SPINE,
    all_passed,
    build,
    check_report,
    models_to_check,
    publish,
    raw_tables,
    write_models,
)
from tidemark.plans.checks import MODEL_CHECKS
from tidemark.plans.semantic import ENGAGEMENT_CONTACTS, HABITS
from tidemark.sources import csv as csv_files
from tidemark.sources.csv import read_csv
from tidemark.sources.load import load_all
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import RESOURCES
from tidemark.sources.schemas import RAW_TABLES


@pytest.fixture(scope="module")
def raw(spark):
    return raw_frames(spark)


@pytest.fixture(scope="module")
def models(raw, tmp_path_factory):
    return write_models(raw, str(tmp_path_factory.mktemp("models")))


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_all_models_are_there(models):
    assert len(MODELS) + 1 == 18  # and the time spine


def test_companies(models):
    found = rows(models["stg_hubspot__companies"], "company_id", "company_name", "company_tier")
    assert found == [(1, "New name", 1), (2, "Beta", None), (3, "Gamma", None), (4, "Delta", None)]


def test_contacts(models):
    found = rows(models["stg_hubspot__contacts"], "contact_id", "company_id", "email")
    assert found == [(10, 1, "b@example.org"), (11, None, None), (12, 99, None)]


def test_engagements(models):
    found = rows(models["stg_hubspot__engagements"], "engagement_id", "engagement_type", "is_synchronous")
    assert found == [
        (100, "MEETING", True), (101, "MEETING", True), (102, "MEETING", True),
        (200, "CALL", True), (201, "CALL", True), (300, "COMMUNICATION", False),
    ]


def test_links(raw, models):
    found = rows(models["stg_hubspot__engagement_contacts"])
    pairs = [(100, 10), (100, 11), (102, 10), (200, 12), (201, 999), (300, 10)]
    assert found == sorted((md5(f"{e}-{c}"), e, c) for e, c in pairs)
    kinds = ("meetings", "calls", "communications")
    links = [raw[f"hubspot__{k}_to_contacts"] for k in kinds]
    assert staging.base_engagement_contacts(*links, dedupe=False).count() == len(pairs) + 1
    assert models["stg_hubspot__engagement_companies"].count() == 0


def test_sleep(models):
    found = rows(models["stg_fitbit__sleep"], "log_id", "duration_ms", "sleep_goal_met")
    assert found == [(1, 11_640_000, False), (2, 25_200_000, True)]
    hours = models["stg_fitbit__sleep"].filter("log_id = 1").first().duration_hr
    assert round(hours, 4) == 3.2333


def test_activities(raw, models):
    first, second = date(2025, 1, 24), date(2025, 1, 25)
    assert rows(models["stg_fitbit__activities"]) == [(first, 7500, True), (second, 0, False)]
    doubled = staging.activities(raw["fitbit__activities"], dedupe=False)
    assert rows(doubled)[0] == (first, 11500, True)


def test_habit_pages(models):
    found = rows(models["stg_notion__daily_habits"], "page_id", "page_date", "did_devotional")
    assert found == [("d1", date(2023, 1, 2), True), ("d2", date(2023, 1, 8), True)]
    weekly = rows(models["stg_notion__weekly_habits"], "page_id", "prayer_minutes")
    assert weekly == [("w1", 20), ("w2", None), ("w3", None)]
    assert models["stg_notion__monthly_habits"].first().page_date == date(2023, 2, 1)


def test_habit_reference(raw, models):
    found = rows(models["stg_notion__habit_reference"], "habit_key", "habit_type", "target_pct")
    assert found == [
        ("did_prayer", "tickbox", 0.8), ("did_read_bible", "tickbox", 0.5),
        ("met_1to1", None, 1.0), ("sleep_minutes", "number", 1.0),
    ]
    doubled = staging.habit_reference(raw["notion__data_source_habit_reference"], dedupe=False)
    assert doubled.count() == 5
    row = models["stg_notion__habit_reference"].filter("habit_key = 'did_prayer'").first()
    assert (row.active, row.frequency, row.start_date) == (True, "daily", date(2023, 1, 1))


def test_unpivoted(models):
    flat = models["int_habits_unpivoted"]
    # 5 + 6 daily flags (one is null), 14 weekly (one page is all null), 6 monthly
    assert rows(flat.groupBy("habit_period").count()) == [("day", 11), ("month", 6), ("week", 14)]
    row = flat.filter("page_id = 'd1' and habit = 'did_prayer'").first()
    assert (row.row_id, row.is_complete) == (md5("d1-did_prayer"), True)


def test_habits(models):
    habits = models["habits_v1"]
    numbers = habits.filter("habit in ('prayer_minutes', 'screen_minutes')")
    assert rows(numbers, "source_id", "habit", "is_complete") == sorted(
        [
            ("w1", "prayer_minutes", True), ("w2", "prayer_minutes", False),
            ("w3", "prayer_minutes", False), ("w1", "screen_minutes", True),
            ("w2", "screen_minutes", None), ("w3", "screen_minutes", False),
        ],
        key=repr,
    )
    met = habits.filter(F.col("habit").startswith("met_"))
    before, week = date(2025, 7, 28), date(2025, 8, 4)
    assert rows(met, "source_id", "habit", "habit_date") == [
        ("100", "met_group", before),  # two contacts, on a Sunday
        ("101", "met_group", week),  # nobody counts as a group
        ("102", "met_1to1", week),
        ("200", "met_1to1", week),
        ("201", "met_1to1", week),
    ]
    steps = habits.filter("habit = 'steps'")
    assert rows(steps, "habit_key", "source_id") == sorted(
        (md5(d), d) for d in ("2025-01-24", "2025-01-25")
    )
    assert habits.count() == 31 + 6 + 2 + 2 + 5


def test_habits_metrics(models):
    metrics = models["habits_metrics_v1"]

    def of(habit):
        found = metrics.filter(F.col("habit") == habit)
        return rows(
            found, "period_start", "report_period", "total_periods", "completed_periods",
            "completion_rate", "target_pct", "target_met",
        )

    # Monday the 2nd and Sunday the 8th are one week.
    assert of("did_prayer") == [(date(2023, 1, 2), "week", 2, 2, 1.0, 0.8, True)]
    assert of("did_journal") == [(date(2023, 1, 2), "week", 2, 1, 0.5, None, None)]
    assert of("did_read_bible") == [(date(2023, 1, 2), "week", 2, 0, 0.0, 0.5, False)]
    assert of("did_language") == [(date(2023, 1, 2), "week", 1, 1, 1.0, None, None)]
    # Weekly pages keep their own date; the unknown flag gives no row.
    assert sorted(r[0] for r in of("screen_minutes")) == [date(2023, 1, 8), date(2023, 1, 22)]
    # Three single meetings reach the threshold of three; groups need one.
    assert of("met_1to1") == [(date(2025, 8, 4), "week", 1, 1, 1.0, 1.0, True)]
    assert [r[3] for r in of("met_group")] == [1, 1]
    assert of("did_training") == [(date(2023, 2, 1), "month", 1, 0, 0.0, None, None)]


def test_weeks_can_be_aligned(models):
    aligned = marts.habits_metrics(
        models["habits_v1"], models["stg_notion__habit_reference"], align_weeks=True
    )
    assert rows(aligned.filter("habit = 'did_fast'"), "period_start")[0] == (date(2023, 1, 2),)


def test_engagement_contacts(models):
    mart = models["engagement_contacts_v1"]
    found = rows(mart, "engagement_id", "contact_id", "company_id", "company_name")
    assert found == sorted(
        [
            (100, 10, 1, "New name"), (100, 11, None, None), (101, None, None, None),
            (102, 10, 1, "New name"), (200, 12, None, None), (201, None, None, None),
            (300, 10, 1, "New name"),
        ],
        key=repr,
    )
    key = mart.filter("engagement_id = 201").first().engagement_key
    assert key == md5("201-_dbt_utils_surrogate_key_null_")


def test_measures(models):
    by_period = measure(
        HABITS, models["habits_v1"], ["habit_completions", "total_habits", "completion_rate"], ["habit_period"]
    )
    month = by_period.filter("habit_period = 'month'").first()
    assert (month.habit_completions, month.total_habits) == (5, 6)
    assert round(month.completion_rate, 4) == 0.8333
    names = [m.name for m in ENGAGEMENT_CONTACTS.measures]
    total = measure(ENGAGEMENT_CONTACTS, models["engagement_contacts_v1"], names)
    assert rows(total, *names) == [(6, 5, 1, 3)]
    by = measure(ENGAGEMENT_CONTACTS, models["engagement_contacts_v1"], names[:1], ["is_synchronous", "engagement_date__month"])
    assert rows(by) == [
        ("asynchronous", date(2025, 8, 1), 1), ("synchronous", date(2025, 8, 1), 5),
    ]


def test_distinct_measures_expand_once_per_column(models):
    names = [m.name for m in ENGAGEMENT_CONTACTS.measures]
    text = plan(measure(ENGAGEMENT_CONTACTS, models["engagement_contacts_v1"], names, ["company_name"]))
    expand = next(line for line in text.splitlines() if "Expand" in line)
    # Two copies of the input, for engagement and contact, and not one per measure.
    assert expand.split("]], ")[0].count("[company_name") == 2


def test_check_report(raw, models):
    results = check_report(raw, models)
    failed = {(r.model, r.check, r.target): r.failures for r in results.filter("not passed").collect()}
    assert failed[("stg_hubspot__contacts", "relationships", "company_id")] == 1
    assert failed[("stg_hubspot__engagement_contacts", "relationships", "contact_id")] == 1
    assert failed[("habits_v1", "not_null", "is_complete")] == 1
    assert failed[("fitbit__sleep", "no_overlap", "start_time,end_time")] == 1
    assert ("habits_v1", "unique", "habit_key") not in failed
    declared = sum(len(c) for n, c in MODEL_CHECKS.items())
    assert results.filter(F.col("model").isin(*MODEL_CHECKS)).count() == declared


def test_checks_write_what_is_read_again_only(raw, models, tmp_path):
    checked = models_to_check(raw, str(tmp_path))
    assert rows(check_report(raw, checked)) == rows(check_report(raw, models))
    kept = {p.name for p in tmp_path.iterdir()}
    assert not kept & {"int_habits_unpivoted", "habits_v1", "habits_metrics_v1", "stg_hubspot__engagements"}
    assert {"base_hubspot__engagements", "stg_notion__daily_habits", "stg_fitbit__activities"} <= kept
    assert set(MODEL_CHECKS) <= set(checked)
    assert "contact_id" in checked["engagement_contacts_v1"].columns
    assert "body_preview" not in checked["engagement_contacts_v1"].columns


def test_publish(spark, raw, tmp_path):
    publish(spark, raw, folder=str(tmp_path))
    published = publish(spark, raw, folder=str(tmp_path))  # a rebuild replaces the tables
    assert spark.table("habits").count() == published["habits_v1"].count() == 46
    assert spark.table("engagement_contacts").count() == 7
    assert spark.table(SPINE).count() == 4017
    comments = {r.col_name: r.comment for r in spark.sql("describe habits_metrics_v1").collect()}
    assert comments["completion_rate"]
    lazy = build(raw, ["habits_metrics_v1"])["habits_metrics_v1"]
    assert rows(lazy) == rows(spark.table("habits_metrics"))


def test_csv_in_both_quotings(spark, tmp_path):
    doubled = tmp_path / "sleep.csv"
    doubled.write_text(
        "date_of_sleep,duration,start_time,end_time,log_id,log_type,type,levels__data\n"
        '2025-06-06,11640000,2025-06-05 23:17:00.000000 UTC,2025-06-06 02:31:00.000000 UTC,489,manual,classic,"[{""level"":""asleep""}]"\n'
    )
    sleep = read_csv(spark, str(doubled), "fitbit__sleep")
    row = staging.sleep(sleep).first()
    assert (row.log_id, row.duration_ms, row.started_at.hour) == (489, 11_640_000, 23)
    backslash = tmp_path / "days.csv"
    names = [c.split()[0] for c in RAW_TABLES["notion__data_source_daily_habits"].split(", ")]
    backslash.write_text(
        ",".join(names) + "\n"
        '"db1","page1","{\\"start\\": \\"2023-01-02\\"}","Day 1",true,true,true,true,true,,"2023-01-01T00:00:00Z","2023-01-01T00:00:00Z"\n'
    )
    pages = read_csv(spark, str(backslash), "notion__data_source_daily_habits", escape="\\")
    row = staging.daily_habits(pages).first()
    assert (row.page_date, row.did_workout, row.did_language) == (date(2023, 1, 2), True, None)


@pytest.mark.parametrize("escape", ['"', "\\"])
def test_csv_files_hold_a_bounded_number_of_rows(spark, tmp_path, escape):
    table = spark.range(0, 1000, 1, 1).selectExpr(
        "string(id) AS id", """id || ' "x, y"' || chr(10) || 'z' AS properties__firstname""")
    csv_files.write_csv(table, str(tmp_path / "out"), escape, file_rows=100)
    assert len(list((tmp_path / "out").glob("part-*"))) == 10
    read = read_csv(spark, str(tmp_path / "out"), "hubspot__contacts", escape)
    found = {(str(r.id), r.properties__firstname) for r in read.collect()}
    assert found == {(r.id, r.properties__firstname) for r in table.collect()}


def test_landed_pages_to_published_tables(spark, tmp_path, land):
    """The whole way: pages on disk, raw tables, models, checks."""
    store = RawStore(spark, str(tmp_path / "raw"))

    def meeting(number, start):
        properties = {"hs_meeting_body": "b", "hs_meeting_start_time": start}
        return {
            "id": str(number), "createdAt": "2025-01-01T00:00:00Z",
            "updatedAt": "2025-01-02T00:00:00Z", "properties": json.dumps(properties),
        }

    land("hubspot__meetings", {"results": [meeting(1, "2025-08-04T10:00:00Z")]})
    link = {"id": "1", "updatedAt": "2025-01-02T00:00:00Z", "results": [{"toObjectId": 10}]}
    land("hubspot__meetings_to_contacts", link)
    deal = {"id": "5", "updatedAt": "2025-01-02T00:00:00Z", "properties": '{"dealname":"D"}'}
    folder = land("hubspot__deals", {"results": [deal]})
    names = ("meetings", "meetings_to_contacts", "deals", "notes")  # no pages of notes
    load_all(store, [RESOURCES[f"hubspot__{n}"] for n in names], folder.rsplit("/", 1)[0], "r1")
    raw = raw_tables(store)
    assert raw["fitbit__sleep"].count() == 0 and "hubspot__notes" not in raw
    models = build(raw, ["habits_v1", "stg_hubspot__engagements"])
    assert rows(models["habits_v1"], "habit", "habit_date") == [("met_1to1", date(2025, 8, 4))]
    results = check_report(raw, {"stg_hubspot__engagements": models["stg_hubspot__engagements"]})
    assert "hubspot__deals" in {r.model for r in results.collect()}
    assert all_passed(results)


def test_one_row_per_source(spark):
    """One record in each raw table, all habits kept: counts worked out by hand."""
    at = datetime(2025, 1, 1)
    one = {
        "hubspot__companies": (1990508, "C", at, at, None),
        "hubspot__contacts": (3018020, None, None, "N", "J", at, at),
        "hubspot__meetings": (7693191, "m", datetime(2025, 11, 25, 22, 2, 51), at, at),
        "hubspot__calls": (4078827, "c", datetime(2025, 8, 4, 1, 38, 3), at, at),
        "hubspot__communications": (2990937, "s", datetime(2025, 5, 26, 13, 10, 12), at, at),
        "hubspot__meetings_to_contacts": (3018020, 7693191, at),
        "hubspot__calls_to_contacts": (3018020, 4078827, at),
        "hubspot__communications_to_contacts": (3018020, 2990937, at),
        "fitbit__sleep": (
            489, date(2025, 6, 6), 11_640_000, datetime(2025, 6, 5, 23, 17),
            datetime(2025, 6, 6, 2, 31), "classic", "manual",
        ),
        "fitbit__activities": (763, "2025-01-24 03:47:00.000000 UTC", 0, at),
        "notion__data_source_daily_habits": page("page1", "2023-01-02", [True] * 6),
        "notion__data_source_weekly_habits": page(
            "page2", "2023-01-08", [True] * 7, extra=('{"number":20}', 520)
        ),
        "notion__data_source_monthly_habits": page("page3", "2023-02-01", [True] * 6),
        "notion__data_source_habit_reference": reference("page4", "Prayer", "Tickbox", 80),
    }
    raw = {n: spark.createDataFrame([fit(n, r)], RAW_TABLES[n]) for n, r in one.items()}
    models = build(raw)
    assert models["stg_hubspot__engagements"].filter("is_synchronous").count() == 2
    contacts = rows(models["engagement_contacts_v1"], "contact_id", "company_id")
    assert contacts == [(3018020, None)] * 3
    assert models["int_habits_unpivoted"].filter("is_complete").count() == 19
    assert rows(models["stg_fitbit__activities"]) == [(date(2025, 1, 24), 0, False)]
    habits = models["habits_v1"]
    assert habits.count() == 25
    assert rows(habits.filter("not is_complete"), "habit") == [("sleep_minutes",), ("steps",)]
    metrics = models["habits_metrics_v1"]
    found = metrics.groupBy("report_period", "period_start").count()
    assert sorted(tuple(r) for r in found.collect()) == [
        ("month", date(2023, 2, 1), 6),
        ("week", date(2023, 1, 2), 6),
        ("week", date(2023, 1, 8), 9),
        ("week", date(2025, 1, 20), 1),
        ("week", date(2025, 6, 2), 1),
        ("week", date(2025, 8, 4), 1),
        ("week", date(2025, 11, 24), 1),
    ]
    matched = metrics.filter("target_pct is not null")
    assert rows(matched, "habit", "completion_rate", "target_pct", "target_met") == [
        ("did_prayer", 1.0, 0.8, True)
    ]
