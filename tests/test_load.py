from __future__ import annotations

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.sources.load import load_all, load_records, load_resource, property_names
from tidemark.sources.pages import date_window
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import ACTIVITIES, DATA_SOURCES, RESOURCES, SLEEP, Resource
from tidemark.streaming import stream_resource

CONTACTS = RESOURCES["hubspot__contacts"]
DAILY_ID = "17b04335-b725-4511-ae86-594ef725706c"


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "raw"))


def contact(number, day, **extra):
    return {
        "id": str(number),
        "createdAt": "2025-08-01T00:00:00.000Z",
        "updatedAt": f"2025-08-{day:02d}T22:16:41.217Z",
        "archived": False,
        "properties": f'{{"email":"p{number}@example.org","firstname":"P","associatedcompanyid":"9"}}',
        **extra,
    }


def land_contacts(land):
    """First run: a page of three and a page of two; second run: one more."""
    first = land("c1", {"results": [contact(n, n) for n in (1, 2, 3)], "paging": {"next": {}}}, 1)
    land("c1", {"results": [contact(n, n) for n in (4, 5)]}, 2, indent=2)
    second = land("c2", {"results": [contact(6, 20)]})
    return first, second


@pytest.mark.parametrize("full_refresh", [False, True])
def test_two_runs(store, land, full_refresh):
    first, second = land_contacts(land)
    load_resource(store, CONTACTS, first, "r1")
    assert store.read("hubspot__contacts").count() == 5
    target = first if full_refresh else second
    load_resource(store, CONTACTS, target, "r2", full_refresh=full_refresh)
    table = store.read("hubspot__contacts")
    assert table.count() == (5 if full_refresh else 6)
    assert set(rows(table, "_load_id")) == ({("r2",)} if full_refresh else {("r1",), ("r2",)})
    types = dict(table.dtypes)
    assert types["id"] == "bigint" and types["updated_at"] == "timestamp"
    assert types["properties__associatedcompanyid"] == "bigint"
    assert rows(table.filter("id = 1"), "properties__email") == [("p1@example.org",)]


def test_rows_at_the_mark_and_late_rows(store, land):
    first, _ = land_contacts(land)
    load_resource(store, CONTACTS, first, "r1")
    again = land("c3", {"results": [contact(5, 5), contact(7, 5), contact(8, 2), contact(9, 9)]})
    load_resource(store, CONTACTS, again, "r2")
    # 5 is stored already, 7 is new at the mark, 8 is older than the mark, 9 is newer.
    assert rows(store.read("hubspot__contacts"), "id") == [(n,) for n in (1, 2, 3, 4, 5, 7, 9)]


def test_a_load_that_is_run_again_changes_nothing(store, land):
    first, second = land_contacts(land)
    for load_id, path in (("r1", first), ("r2", second), ("r2", second), ("r1", first)):
        load_resource(store, CONTACTS, path, load_id)
    assert store.read("hubspot__contacts").count() == 6


def test_an_unfinished_load_is_invisible(spark, store, land):
    first, _ = land_contacts(land)
    load_resource(store, CONTACTS, first, "r1")
    half = store.read("hubspot__contacts").write
    half.parquet(f"{store.root}/hubspot__contacts/_resource=hubspot__contacts/_load=r2")  # no commit followed
    assert store.read("hubspot__contacts").count() == 5


def test_record_without_cursor_stops_the_load(store, land):
    bad = contact(1, 1)
    del bad["updatedAt"]
    path = land("bad", {"results": [bad]})
    with pytest.raises(Exception, match="record without cursor"):
        load_resource(store, CONTACTS, path, "r1")


def test_date_window_bounds(store, land):
    first, _ = land_contacts(land)
    options = {"start": "2025-08-02", "end": "2025-08-04T22:16:41.217Z"}
    load_resource(store, CONTACTS, first, "r1", **options)
    assert rows(store.read("hubspot__contacts"), "id") == [(2,), (3,), (4,)]


def test_window_flags(spark):
    df = spark.range(5)
    assert date_window(df, "id", 1, 3).count() == 3
    assert date_window(df, "id", 1, 3, include_start=False, include_end=False).count() == 1
    assert date_window(df, "id", 1).count() == 4


def test_new_columns_and_changed_types(spark, store):
    store.append("t", spark.createDataFrame([(1, "a")], "id int, v string"), "r1")
    store.append("t", spark.createDataFrame([(2, 5, True)], "id int, v int, w boolean"), "r2")
    table = store.read("t")
    assert rows(table, "id", "v", "w", "v__v_integer") == [(1, "a", None, None), (2, None, True, 5)]


def test_all_properties(store, land):
    odd = contact(1, 1, properties='{"email":"a@example.org","favourite":"tea"}')
    path = land("odd", {"results": [odd]})
    load_resource(store, CONTACTS, path, "r1", all_properties=True)
    assert rows(store.read("hubspot__contacts"), "properties__favourite") == [("tea",)]


def test_property_names(spark):
    df = spark.createDataFrame([('{"b": 1}',), ('{"a": 1, "b": 2}',)], "properties string")
    assert property_names(df) == ["a", "b"]


def test_properties_as_object(store, land):
    path = land("obj", {"results": [contact(1, 1, properties={"email": "o@example.org"})]})
    load_resource(store, CONTACTS, path, "r1")
    assert rows(store.read("hubspot__contacts"), "properties__email") == [("o@example.org",)]


def schema_document(name):
    return {
        "id": "123",
        "name": name,
        "labels": {"singular": "Thing", "plural": "Things"},
        "requiredProperties": '["p"]',
        "secondaryDisplayProperties": ["s"],
        "associations": [{"id": "1", "name": "to_contact"}, {"id": "2", "name": "to_company"}],
        "properties": [
            {"name": "p1", "options": [{"label": "A"}], "modificationMetadata": {"archivable": True}}
        ],
        "createdAt": "2025-08-16T22:17:41.494Z",
        "updatedAt": "2025-08-16T22:17:41.494Z",
    }


@pytest.mark.parametrize("full_refresh", [False, True])
def test_schemas_merge_into_one_row(store, land, full_refresh):
    schemas = [r for r in RESOURCES.values() if r.target == "hubspot__schemas"]
    assert len(schemas) == 9
    chosen = schemas[:3]
    for resource in chosen:
        path = land(resource.name, schema_document("thing"))
    landing = path.rsplit("/", 1)[0]
    load_all(store, chosen, landing, "r1")
    load_all(store, chosen, landing, "r2", full_refresh=full_refresh)
    table = store.read("hubspot__schemas")
    assert rows(table, "id", "labels__singular") == [("123", "Thing")]
    assert rows(table, "secondary_display_properties") == [('["s"]',)]
    assert store.read("hubspot__schemas__associations").count() == 2
    child = store.read("hubspot__schemas__properties")
    assert rows(child, "options") == [('[{"label":"A"}]',)]


def test_merge_replaces_by_key(spark, store):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (2, "B"), (3, "C")], "id int, v string")
    store.append("t", old, "r1")
    store.merge("t", new, "r2", ["id"])
    assert rows(store.read("t")) == [(1, "a"), (2, "B"), (3, "C")]
    stale = store.vacuum("t")
    assert len(stale) == 1
    assert rows(store.read("t")) == [(1, "a"), (2, "B"), (3, "C")]


def test_links_carry_parent_keys(store, land):
    page = {
        "id": "77",
        "updatedAt": "2025-01-10T15:00:00Z",
        "results": [
            {"toObjectId": 5, "associationTypes": [{"category": "X", "typeId": 200}]},
            {"toObjectId": 6, "associationTypes": []},
        ],
    }
    resource = RESOURCES["hubspot__meetings_to_contacts"]
    load_resource(store, resource, land("links", page), "r1")
    table = store.read("hubspot__meetings_to_contacts")
    assert rows(table, "_hubspot__meetings_id", "to_object_id") == [(77, 5), (77, 6)]
    assert rows(table, "association_types") == [('[]',), ('[{"category":"X","typeId":200}]',)]


def test_fitness_pages(store, land):
    sleep = {
        "logId": 1, "dateOfSleep": "2024-06-01", "duration": 28800000, "efficiency": 95,
        "startTime": "2024-06-01T00:00:00.000", "endTime": "2024-06-01T08:00:00.000",
        "levels": {"data": [{"level": "asleep"}], "summary": {"asleep": {"count": 1}}},
    }
    load_resource(store, SLEEP, land("s", {"sleep": [sleep]}), "r1")
    row = store.read("fitbit__sleep").first()
    assert (row.log_id, row.levels__data) == (1, '[{"level":"asleep"}]')
    activity = {
        "logId": 2, "lastModified": "2024-06-01T10:00:00.000Z", "startTime": "2024-06-01T10:00:00.000Z",
        "steps": 2500, "activityLevel": [{"name": "lightly", "minutes": 5}],
        "source": {"type": "api", "trackerFeatures": ["STEPS"]},
    }
    load_resource(store, ACTIVITIES, land("a", {"activities": [activity]}), "r1")
    row = store.read("fitbit__activities").first()
    assert row.activity_level == '[{"minutes":5,"name":"lightly"}]'
    assert (row.source__tracker_features, row.start_time[:10]) == ('["STEPS"]', "2024-06-01")


def habit_page(number, day, source=DAILY_ID):
    return {
        "object": "page",
        "id": f"page-{number}",
        "created_time": "2024-06-01T19:05:00.000Z",
        "last_edited_time": f"2024-06-{day:02d}T20:25:00.000Z",
        "parent": {"type": "data_source_id", "data_source_id": source},
        "properties": {
            "Name": {"id": "title", "type": "title", "title": [{"type": "text", "plain_text": "x"}]},
            "Date": {"id": "d", "type": "date", "date": {"start": "2024-06-01", "end": None}},
            "Read Bible": {"id": "c", "type": "checkbox", "checkbox": True},
        },
    }


@pytest.mark.parametrize("full_refresh", [False, True])
def test_pages_are_routed_by_data_source(store, land, full_refresh):
    resource = RESOURCES["notion__data_source_rows"]
    first = land("n1", {"object": "list", "results": [habit_page(n, n) for n in (1, 2, 3)]}, 1)
    land("n1", {"object": "list", "results": [habit_page(4, 4), habit_page(5, 5, "new-source")]}, 2)
    second = land("n2", {"results": [habit_page(6, 9)]})
    load_resource(store, resource, first, "r1")
    name = "notion__data_source_daily_habits"
    assert store.read(name).count() == 4
    assert rows(store.read("notion__data_source_new_source"), "id") == [("page-5",)]
    load_resource(store, resource, first if full_refresh else second, "r2", full_refresh=full_refresh)
    table = store.read(name)
    assert table.count() == (4 if full_refresh else 5)
    assert rows(table.filter("id = 'page-1'"), "properties__date__date") == [('{"start":"2024-06-01"}',)]
    assert "properties__read_bible__checkbox" in table.columns
    assert "object" not in table.columns and "parent__type" not in table.columns


def test_data_sources(store, land):
    record = {
        "object": "data_source", "id": DAILY_ID, "created_time": "2024-01-01T00:00:00.000Z",
        "last_edited_time": "2024-06-01T00:00:00.000Z", "parent": {"type": "page_id", "page_id": "x"},
        "title": [{"type": "text", "text": {"content": "Daily"}, "plain_text": "Daily"}],
    }
    load_resource(store, DATA_SOURCES, land("ds", {"results": [record]}), "r1")
    table = store.read("notion__data_sources")
    assert rows(table, "title") == [('[{"text":{"content":"Daily"},"plain_text":"Daily"}]',)]


def test_stream_keeps_its_place(spark, store, land, tmp_path):
    folder = land("st", {"results": [contact(n, n) for n in (1, 2, 3)]}, 1)
    checkpoint = str(tmp_path / "ck")

    def run():
        stream_resource(
            store, CONTACTS, folder, checkpoint, files_per_batch=1
        ).awaitTermination()
        return store.read("hubspot__contacts").count()

    assert run() == 3
    land("st", {"results": [contact(4, 4), contact(5, 5)]}, 2)
    assert run() == 5
    assert run() == 5


def test_stream_upsert(spark, store, land, tmp_path):
    resource = Resource(
        name="app__things", selector="results", record="id bigint, v string, at string",
        cursor="at", disposition="merge", keys=("id",),
    )
    at = "2025-01-01T00:00:00Z"
    folder = land("up", {"results": [{"id": 1, "v": "a", "at": at}, {"id": 2, "v": "b", "at": at}]}, 1)
    stream_resource(store, resource, folder, str(tmp_path / "ck")).awaitTermination()
    land("up", {"results": [{"id": 2, "v": "B", "at": at}]}, 2)
    stream_resource(store, resource, folder, str(tmp_path / "ck")).awaitTermination()
    assert rows(store.read("app__things"), "id", "v") == [(1, "a"), (2, "B")]


def test_one_page_per_line(store, tmp_path):
    (tmp_path / "lines").mkdir()
    at = '"updatedAt": "2025-01-01T00:00:00Z"'
    (tmp_path / "lines" / "pages.json").write_text(f'{{"results": [{{"id": "1", {at}}}]}}\n\n{{"results": [{{"id": "2", {at}}}]}}\n')
    load_resource(store, CONTACTS, str(tmp_path / "lines"), "r1", multiline=False)
    assert rows(store.read("hubspot__contacts"), "id") == [(1,), (2,)]


def test_a_page_that_is_no_json_stops_the_load(store, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "page.json").write_text('{"results": [')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        load_resource(store, CONTACTS, str(tmp_path / "broken"), "r1")
    assert not store.exists("hubspot__contacts")


def test_resources_cover_every_object():
    names = set(RESOURCES)
    for kind in ("contacts", "companies", "meetings", "calls", "communications", "tasks", "notes", "deals", "tickets"):
        assert f"hubspot__{kind}" in names and f"hubspot__schemas_{kind}" in names
    assert sum(n.endswith("_to_contacts") for n in names) == 7


def test_empty_page_loads_no_rows(store, land):
    load_resource(store, CONTACTS, land("none", {"results": []}), "r1")
    assert store.read("hubspot__contacts").count() == 0
    assert store.high_water_mark("hubspot__contacts") is None


def test_load_records_from_a_frame(spark, store):
    resource = Resource(name="app__e", selector="$", record=None, cursor="at", cursor_type="bigint")
    df = spark.range(15).select(F.col("id"), F.col("id").alias("at"))  # 9 and 10 order as numbers
    load_records(store, resource, df.filter("id < 9"), "r1", start=0)
    load_records(store, resource, df.filter("id < 11"), "r2", start=0)
    load_records(store, resource, df, "r3", start=0)
    assert store.high_water_mark("app__e") == "14"
    assert store.read("app__e").count() == 15


def test_many_rows_at_the_mark(spark, store):
    resource = Resource(name="app__e", selector="$", record=None, cursor="at", cursor_type="bigint")
    df = spark.range(40).select(F.col("id"), (F.col("id") % 2).alias("at"))
    load_records(store, resource, df.filter("id < 20"), "r1", start=0)
    load_records(store, resource, df, "r2", start=0)
    # Late rows below the mark are left out, rows at the mark come once.
    assert store.read("app__e").count() == 30


def test_a_routed_load_that_is_run_again_changes_nothing(store, land):
    resource = RESOURCES["notion__data_source_rows"]
    path = land("n3", {"results": [habit_page(1, 1)]})
    load_resource(store, resource, path, "r1")
    land("n3", {"results": [habit_page(2, 2)]}, 2)
    load_resource(store, resource, path, "r1")
    assert store.read("notion__data_source_daily_habits").count() == 1


def test_routed_rows_without_key_and_with_other_types(spark, tmp_path):
    resource = Resource(name="mixed", selector="$", record="id long, kind string", route_column="kind", route_prefix="m__")
    store = RawStore(spark, str(tmp_path / "routed"))
    loads = [
        ("id long, kind string, v long, w boolean", [(1, "a", 80, True), (2, None, 81, False)]),
        ("id long, kind string, v double, w string", [(3, "a", 80.5, "x"), (4, None, 1.5, "y"), (5, "b", 2.5, "z")]),
        ("id long, kind string, v long, w boolean", [(6, "a", 82, None), (7, "b", 3, True)]),
    ]
    for i, (schema, rows) in enumerate(loads):
        load_records(store, resource, spark.createDataFrame(rows, schema), f"run-{i}")
    assert store.tables() == ["m__a", "m__b", "m__unrouted"]
    found = {t: sorted((r.id, r.v, r.asDict().get("v__v_double")) for r in store.read(t).collect()) for t in ("m__a", "m__unrouted")}
    assert found == {
        "m__a": [(1, 80, None), (3, None, 80.5), (6, 82, None)],
        "m__unrouted": [(2, 81, None), (4, None, 1.5)],
    }
    # One schema for all targets of a resource: a type that is new to one may be known from another.
    b = sorted((r.id, r.v, r.w, r.v__v_double, r.w__v_string) for r in store.read("m__b").collect())
    assert b == [(5, None, None, 2.5, "z"), (7, 3, True, None, None)]
    text = plan(store.read("m__b"))
    assert "PartitionFilters: [isnotnull(_table" in text or "(_table" in text.split("PartitionFilters")[1].split("]")[0]


def test_merge_keeps_the_newest_version(spark, tmp_path):
    store = RawStore(spark, str(tmp_path / "merged"))
    make = lambda rows: spark.createDataFrame(rows, "id long, name string, at date")
    from datetime import date

    first = [(1, "zebra-old", date(2024, 1, 1)), (1, "alpha-new", date(2024, 2, 1)), (2, "two", date(2024, 1, 5))]
    store.merge("t", make(first), "run-1", ["id"], cursor="at")
    late = [(1, "late", date(2023, 1, 1)), (2, "two again", date(2024, 1, 6)), (3, "three", date(2020, 1, 1))]
    store.merge("t", make(late), "run-2", ["id"], cursor="at")
    assert sorted((r.id, r.name) for r in store.read("t").collect()) == [(1, "alpha-new"), (2, "two again"), (3, "three")]
    assert store.high_water_mark("t") == "2024-02-01"


def test_row_ids_of_rows_that_look_alike_differ(spark):
    from tidemark.functions import row_hash

    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "c"), ("a", None), (None, None)], "x string, y string")
    assert df.select(row_hash(df.schema).alias("h")).distinct().count() == 5
