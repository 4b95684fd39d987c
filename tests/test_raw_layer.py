"""Fields that nobody declared, loads that read only what is new, merges that touch few partitions."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import canonical_json, row_hash
from tidemark.sources import load as load_module
from tidemark.sources.load import landed_pages, landed_records, load_resource
from tidemark.sources.pages import evolved
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import RESOURCES, Resource
from tidemark.streaming import stream_resource
from test_load import DAILY_ID, habit_page, schema_document

THINGS = Resource(name="app__things", selector="results", record="id bigint, at string", cursor="at")
AT = "2025-01-01T00:00:00Z"


@pytest.fixture
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "raw"))


def test_undeclared_fields_are_kept(store, land):
    path = land("u", {"results": [
        {"id": "1", "at": AT, "note": "plain", "size": 2, "void": None, "more": {"Deep Field": {"x": 1}}},
        {"id": "2", "at": AT, "note": {"text": "rich", "marks": [1, 2]}, "size": 2.5, "tags": ["a", 1]},
        {"id": "3", "at": AT, "note": 7},
    ]})
    load_resource(store, THINGS, path, "r1")
    table = store.read("app__things")
    assert rows(table, "id", "note", "note__v_json", "size") == [
        (1, "plain", None, 2.0), (2, None, '{"marks":[1,2],"text":"rich"}', 2.5), (3, "7", None, None),
    ]
    assert "void" not in table.columns
    assert rows(table.filter("id = 1"), "more__deep_field__x") == [(1,)]
    assert rows(store.read("app__things__tags"), "value") == [("1",), ("a",)]


def test_a_field_that_comes_later_and_one_whose_type_changes(store, land):
    path = land("l", {"results": [{"id": 1, "at": AT, "v": 5}]}, 1)
    load_resource(store, THINGS, path, "r1")
    land("l", {"results": [{"id": 2, "at": "2025-02-01T00:00:00Z", "v": "five", "w": True}]}, 2)
    load_resource(store, THINGS, path, "r2")
    assert rows(store.read("app__things"), "id", "v", "v__v_string", "w") == [(1, 5, None, None), (2, None, "five", True)]


def test_fields_added_to_a_declared_object(store, land):
    resource = Resource(name="app__deep", selector="$", record="id bigint, source struct<name: string>")
    load_resource(store, resource, land("d", {"id": 1, "source": {"name": "x", "extra": {"y": [3]}}}), "r1")
    assert rows(store.read("app__deep"), "source__name") == [("x",)]
    assert rows(store.read("app__deep__source__extra__y"), "value") == [(3,)]


def test_evolved_types():
    found = T.DataType.fromDDL("STRUCT<a: BIGINT, b: DECIMAL(3,1), c: VOID, l: ARRAY<STRUCT<x: VARIANT, y: VOID>>, v: VARIANT>")
    kind = evolved(T.StructType.fromDDL("a string"), found)
    assert kind.simpleString() == "struct<a:string,b:double,l:array<struct<x:string>>,v:variant>"
    assert evolved(None, T.NullType()) is None


def test_a_load_reads_its_own_pages_only(spark, store, land, tmp_path):
    path = land("own", {"results": [{"id": 1, "at": AT}]}, 1)
    load_resource(store, THINGS, path, "r1")
    land("own", {"results": [{"id": 2, "at": "2025-02-01T00:00:00Z"}]}, 2)
    load_resource(store, THINGS, path, "r2")
    text = plan(landed_pages(store, THINGS, "r2"))
    assert "(load" in text.split("PartitionFilters: ")[1].split("]")[0] and "r2" in text
    assert rows(landed_records(store, THINGS, "r2"), "id") == [(2,)]
    # Nothing is new: no page is read, and no load recorded.
    load_resource(store, THINGS, path, "r3")
    pages = Path(store.root) / "_pages" / "app__things"
    assert sorted(p.name for p in pages.glob("load=*")) == ["load=r1", "load=r2"]
    assert [r.load_id for r in store.loads()] == ["r1", "r2"]


def test_a_failed_load_leaves_its_pages_to_the_next(store, land, monkeypatch):
    path = land("f", {"results": [{"id": 1, "at": AT}]}, 1)
    load = load_module.load_records
    calls = []

    def failing(*args, **options):
        calls.append(args[3])
        if len(calls) == 1:
            raise RuntimeError("lost")
        return load(*args, **options)

    monkeypatch.setattr(load_module, "load_records", failing)
    with pytest.raises(Exception, match="lost"):
        load_resource(store, THINGS, path, "r1")
    land("f", {"results": [{"id": 2, "at": AT}]}, 2)
    load_resource(store, THINGS, path, "r2")
    assert calls == ["r1", "r2", "r2.1"]
    assert rows(store.read("app__things"), "id") == [(1,), (2,)]


def test_row_ids_hang_on_fields_with_values_only(spark, store, land):
    df = spark.createDataFrame([(1, "a", [(1, None)])], "b int, a string, l array<struct<x: int, y: int>>")
    wider = df.select("l", F.lit(None).cast("string").alias("new"), "a", "b")
    assert df.select(row_hash(df.schema)).first()[0] == wider.select(row_hash(wider.schema)).first()[0]
    value = 'a\\","x":null}'
    odd = json.dumps({"k": value, "n": None, "o": {"p": None, "q": 1}, "z": None})
    text = spark.createDataFrame([(odd,), (json.dumps({"o": {"q": 1}, "k": value}),)], "v string")
    assert text.select(canonical_json(F.parse_json("v"))).distinct().count() == 1
    # Rows at the mark come again with a field that has no value: they are not stored twice.
    path = land("m", {"results": [{"id": 1, "at": AT}]}, 1)
    load_resource(store, THINGS, path, "r1")
    land("m", {"results": [{"new": None, "at": AT, "id": 1}, {"id": 2, "at": AT}]}, 2)
    load_resource(store, THINGS, path, "r2")
    assert rows(store.read("app__things"), "id") == [(1,), (2,)]


def files_of(folder):
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_a_merge_rewrites_the_partitions_it_touches(spark, tmp_path):
    store = RawStore(spark, str(tmp_path / "raw"), buckets=8)
    first = spark.range(4000).select("id", F.lit("old").alias("v"))
    store.merge("t", first, "r1", ["id"])
    path = store.loads("t")[-1].path
    before = files_of(path)
    assert len({p.parent.name for p in before}) == 8
    one = spark.read.parquet(path).filter("_bucket = 3").select("id").limit(5)
    store.merge("t", one.withColumn("v", F.lit("new")), "r2", ["id"])
    after = files_of(path)
    changed = {p.parent.name for p in set(before.items()) ^ set(after.items()) for p in [p[0]]}
    assert changed == {"_bucket=3"}
    table = store.read("t")
    assert table.count() == 4000 and table.filter("v = 'new'").count() == 5
    assert table.columns == ["id", "v"]
    # Rows appended to it are merged with the rest, and a replace starts anew.
    store.append("t", spark.range(4000, 4002).select("id", F.lit("late").alias("v")), "r3")
    assert store.read("t").count() == 4002
    store.merge("t", spark.range(4001, 4003).select("id", F.lit("newer").alias("v")), "r4", ["id"])
    assert rows(store.read("t").filter("id > 3999")) == [(4000, "late"), (4001, "newer"), (4002, "newer")]
    store.replace("t", spark.range(1).select("id", F.lit("only").alias("v")), "r5")
    store.merge("t", spark.range(1, 2).select("id", F.lit("x").alias("v")), "r6", ["id"])
    assert rows(store.read("t")) == [(0, "only"), (1, "x")]
    store.vacuum("t")
    assert rows(store.read("t")) == [(0, "only"), (1, "x")]


def test_children_of_replaced_rows_are_gone(store, land):
    resource = RESOURCES["hubspot__schemas_contacts"]
    document = schema_document("thing")
    path = land(resource.name, document, 1)
    load_resource(store, resource, path, "r1")
    assert store.read("hubspot__schemas__associations").count() == 2
    land(resource.name, {**document, "name": "renamed", "associations": document["associations"][:1]}, 2)
    load_resource(store, resource, path, "r2")
    assert rows(store.read("hubspot__schemas"), "name") == [("renamed",)]
    assert rows(store.read("hubspot__schemas__associations"), "name") == [("to_contact",)]
    # The old version again: its children are there once.
    land(resource.name, document, 3)
    load_resource(store, resource, path, "r3")
    assert store.read("hubspot__schemas__associations").count() == 2


def test_counts_come_from_the_pass_that_writes(spark, store):
    store.append("t", spark.range(7).select("id"), "r1", cursor="id")
    store.append("t", spark.range(0).select("id"), "r2", cursor="id")
    assert [(r.n_rows, r.cursor_max) for r in store.loads("t")] == [(7, "6"), (0, None)]
    assert store.read("t").count() == 7


def test_the_notes_source_as_a_stream(store, land, tmp_path):
    resource = RESOURCES["notion__data_source_rows"]
    folder = land("notes", {"results": [habit_page(1, 1), habit_page(2, 2, "other")]}, 1)
    run = lambda: stream_resource(store, resource, folder, str(tmp_path / "ck"), files_per_batch=1).awaitTermination()
    run()
    extra = habit_page(3, 3)
    extra["properties"]["Journal"] = {"id": "j", "type": "checkbox", "checkbox": False}
    land("notes", {"results": [extra]}, 2)
    run()
    run()
    table = store.read("notion__data_source_daily_habits")
    assert rows(table, "id", "properties__journal__checkbox") == [("page-1", None), ("page-3", False)]
    assert store.tables() == ["notion__data_source_daily_habits", "notion__data_source_other"]
    assert rows(table, "parent__data_source_id") == [(DAILY_ID,)] * 2


def test_row_hook(store, land):
    def hook(records):
        return records.filter("id <> 2").withColumn("double_id", F.col("id") * 2)

    resource = Resource(name="app__hooked", selector="results", record="id bigint, at string", cursor="at", transform=hook)
    load_resource(store, resource, land("h", {"results": [{"id": n, "at": AT} for n in (1, 2, 3)]}), "r1")
    assert rows(store.read("app__hooked"), "id", "double_id") == [(1, 2), (3, 6)]


def test_jobs_from_the_command_line(spark, land, tmp_path, monkeypatch, capsys):
    """Batch and stream loads of the notes source into tables named on the command line."""
    from tidemark import __main__ as jobs

    monkeypatch.setattr(jobs, "get_session", lambda app: spark)
    land("notion__data_source_rows", {"results": [habit_page(1, 1, "own-id")]}, 1)
    landing = str(tmp_path / "landing")
    for raw, extra in (("batch", ["--load-id", "r1"]), ("stream", ["--stream", "--files-per-batch", "1"])):
        argv = ["tidemark", "load", "--raw", str(tmp_path / raw), "--landing", landing, "--source", "notion",
                "--notes-table", "own-id=journal", *extra]
        monkeypatch.setattr("sys.argv", argv)
        assert jobs.main() == 0
        store = RawStore(spark, str(tmp_path / raw))
        assert store.tables() == ["notion__data_source_journal"]
        assert rows(store.read("notion__data_source_journal"), "id") == [("page-1",)]
