"""Queries for landing pages, shaping records and loading raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import shared_dir
from tidemark.functions import cursor_day, epoch_ms, epoch_ms_to_iso, from_epoch_ms
from tidemark.operators import route_by_key, union_all
from tidemark.sources.load import load_records, load_resource, with_load_audit
from tidemark.sources.nested import exclude_fields, flatten
from tidemark.sources.pages import (
    date_window,
    explode_association,
    page_records,
    project_properties,
)
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import Resource
from tidemark.sources.schemas import schema_of
from tidemark.streaming import stream_resource
from workload.registry import query
from workload.standins import given

HALF = "2024-01-15"

EVENTS = Resource(
    name="app__events",
    selector="results",
    record=(
        "event_id bigint, ts string, user_id bigint, event_type string, value double, "
        "props string"
    ),
    cursor="ts",
)
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def _land(df: DataFrame, folder: str) -> None:
    """Write rows as pages, one page of one record per line."""
    text = df.withColumn("ts", F.col("ts").cast("string"))
    record = F.struct(*text.columns)
    text.select(F.to_json(F.struct(F.array(record).alias("results")))).write.text(folder)


def _loaded_events(store: RawStore) -> DataFrame:
    return store.read(EVENTS.name).select(*EVENT_COLUMNS)


@query(
    "page_explode",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, 'status' AS kind, o_orderstatus AS value FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'priority', o_orderpriority FROM orders
    UNION ALL
    SELECT CAST(o_orderkey AS VARCHAR), 'customer', CAST(o_custkey AS VARCHAR) FROM orders
    """,
)
def page_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders")
    values = {"status": "o_orderstatus", "priority": "o_orderpriority", "customer": "o_custkey"}
    records = [
        F.struct(
            F.col("o_orderkey").cast("string").alias("id"),
            F.lit(kind).alias("kind"),
            F.col(column).cast("string").alias("value"),
        )
        for kind, column in values.items()
    ]
    page = F.struct(F.lit(3).alias("total"), F.array(*records).alias("results"))
    pages = orders.select(F.to_json(page).alias("page"))
    record = schema_of("id string, kind string, value string")
    return page_records(pages, "page", record, "results")


@query(
    "date_window_pull",
    """
    SELECT event_id, ts, user_id FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'
    """,
)
def date_window_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    return date_window(events, "ts", "2024-01-05", "2024-01-20").select("event_id", "ts", "user_id")


@query(
    "incremental_append",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half is landed and loaded, then everything is landed once more; a third load finds nothing new."""
    events = given(spark, sf_dir, "events")
    folder = shared_dir(spark, "incremental")
    store = RawStore(spark, f"{folder}/raw")
    for run, part in enumerate((events.filter(F.col("ts") < HALF), events, None), 1):
        if part is not None:
            _land(part, f"{folder}/pages/{run}")
        load_resource(store, EVENTS, f"{folder}/pages/*", f"run-{run}", multiline=False)
    return _loaded_events(store)


@query(
    "incremental_append_stream",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def incremental_append_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing landing folder; the checkpoint keeps them apart."""
    events = given(spark, sf_dir, "events")
    folder = shared_dir(spark, "stream")
    store = RawStore(spark, f"{folder}/raw")
    for run, part in enumerate((F.col("ts") < HALF, F.col("ts") >= HALF)):
        _land(events.filter(part), f"{folder}/pages/{run}")
        stream_resource(
            store, EVENTS, f"{folder}/pages/*", f"{folder}/checkpoint", multiline=False
        ).awaitTermination()
    return _loaded_events(store)


@query(
    "full_refresh",
    f"""
    SELECT event_id, ts, user_id, event_type, value, props FROM events
    WHERE ts >= TIMESTAMP '{HALF}'
    """,
)
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    store = RawStore(spark, shared_dir(spark, "refresh"))
    load_records(store, EVENTS, events.filter(F.col("ts") < HALF), "run-1")
    load_records(store, EVENTS, events.filter(F.col("ts") >= HALF), "run-2", full_refresh=True)
    return _loaded_events(store)


@query(
    "merge_upsert",
    """
    SELECT p_partkey, p_name, p_brand,
           CASE WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 ELSE p_retailprice END
               AS p_retailprice
    FROM part
    UNION ALL
    SELECT p_partkey + 1000000000, p_name, p_brand, p_retailprice FROM part WHERE p_size > 25
    """,
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a third of the keys in one batch, late older versions, new keys twice."""
    columns = ["p_partkey", "p_name", "p_brand", "p_retailprice"]
    part = given(spark, sf_dir, "part").select(*columns, "p_size")

    def version(rows: DataFrame, number: int, times: int) -> DataFrame:
        price = F.col("p_retailprice") * times
        return rows.select(*columns[:3], price.alias("p_retailprice"), F.lit(number).cast("long").alias("version"))

    changed = part.filter(F.col("p_partkey") % 3 == 0)
    late = part.filter(F.col("p_partkey") % 3 == 1)
    new = part.filter(F.col("p_size") > 25).withColumn(
        "p_partkey", F.col("p_partkey") + 1_000_000_000
    )
    incoming = version(changed, 4, 2).union(version(changed, 3, 5)).union(version(late, 1, 9))
    incoming = incoming.union(version(new, 2, 1)).union(version(new, 2, 1))
    store = RawStore(spark, shared_dir(spark, "merge"))
    store.append("shop__part", version(part, 2, 1), "run-1")
    store.merge("shop__part", incoming, "run-2", ["p_partkey"], cursor="version")
    store.merge("shop__part", version(changed, 3, 7), "run-3", ["p_partkey"], cursor="version")
    return store.read("shop__part").select(*columns)


@query(
    "epoch_convert",
    """
    SELECT event_id, ms, make_timestamp(ms * 1000) AS at,
           strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S')
             || CASE WHEN ms % 1000 <> 0 THEN strftime(make_timestamp(ms * 1000), '.%f')
                     ELSE '' END
             || '+00:00' AS iso,
           strftime(ts, '%Y-%m-%d') AS day
    FROM (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms FROM events)
    """,
)
def epoch_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_ms = given(spark, sf_dir, "events").withColumn("ms", epoch_ms("ts"))
    return with_ms.select(
        "event_id",
        "ms",
        from_epoch_ms("ms").alias("at"),
        epoch_ms_to_iso("ms").alias("iso"),
        cursor_day("ts").alias("day"),
    )


def _nested_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as page records: objects in objects, lists, bookkeeping fields."""
    field = F.struct(
        F.lit("f1").alias("id"),
        F.lit("select").alias("type"),
        F.col("c_mktsegment").alias("name"),
        F.array(
            F.struct(
                F.lit("text").alias("type"),
                F.col("c_name").alias("plainText"),
                F.struct(F.lit(True).alias("bold")).alias("annotations"),
            )
        ).alias("richText"),
    )
    return given(spark, sf_dir, "customer").select(
        F.lit("page").alias("object"),
        F.col("c_custkey").alias("id"),
        F.struct(
            F.lit("db").alias("type"), F.col("c_nationkey").alias("dataSourceId")
        ).alias("parent"),
        F.struct(field.alias("Market Segment")).alias("properties"),
    )


@query(
    "flatten_nested",
    """
    SELECT 'page' AS object, c_custkey AS id, 'db' AS parent__type,
           c_nationkey AS parent__data_source_id, 'f1' AS properties__market_segment__id,
           'select' AS properties__market_segment__type,
           c_mktsegment AS properties__market_segment__name
    FROM customer
    """,
)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = flatten(_nested_customers(spark, sf_dir))
    return root.drop("_row_id")


@query(
    "json_column_hint",
    """
    SELECT 'page' AS object, c_custkey AS id, 'db' AS parent__type,
           c_nationkey AS parent__data_source_id,
           '{"id":"f1","type":"select","name":"' || c_mktsegment
             || '","richText":[{"type":"text","plainText":"' || c_name
             || '","annotations":{"bold":true}}]}' AS properties__market_segment
    FROM customer
    """,
)
def json_column_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = flatten(_nested_customers(spark, sf_dir), max_nesting=1)
    return root


@query(
    "exclude_fields",
    """
    SELECT c_custkey AS id, c_nationkey AS parent__data_source_id,
           c_mktsegment AS properties__market_segment__name,
           '[{"plainText":"' || c_name || '"}]' AS properties__market_segment__rich_text
    FROM customer
    """,
)
def exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = ["$..object", "$..type", "$.properties.*.id", "$.properties..annotations"]
    pruned = exclude_fields(_nested_customers(spark, sf_dir), paths)
    return flatten(pruned, max_nesting=2)[0]


_NOTES_JSON = """'[{"kind":"status","text":"' || o_orderstatus
    || '"},{"kind":"priority","text":"' || o_orderpriority || '"}]'"""


@query(
    "child_tables",
    f"""
    SELECT md5('{{"notes":' || {_NOTES_JSON} || ',"o_orderkey":' || o_orderkey || '}}') AS _parent_id,
           i AS _list_idx, CASE i WHEN 0 THEN 'status' ELSE 'priority' END AS kind,
           CASE i WHEN 0 THEN o_orderstatus ELSE o_orderpriority END AS text
    FROM orders CROSS JOIN (SELECT unnest([0, 1]) AS i) numbers
    """,
)
def child_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of objects becomes a table of its own that points to the parent row."""
    notes = [
        F.struct(F.lit(kind).alias("kind"), F.col(column).alias("text"))
        for kind, column in (("status", "o_orderstatus"), ("priority", "o_orderpriority"))
    ]
    records = given(spark, sf_dir, "orders").select("o_orderkey", F.array(*notes).alias("notes"))
    return flatten(records)[1]["notes"]


@query(
    "association_explode",
    """
    SELECT l_orderkey AS _shop__orders_id, l_shipdate AS _shop__orders_updated_at,
           l_partkey AS to_object_id, 'part' AS label FROM lineitem
    UNION ALL
    SELECT l_orderkey, l_shipdate, l_suppkey, 'supplier' FROM lineitem
    """,
)
def association_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line is a response for its order with two linked objects."""
    linked = [
        F.struct(F.col(c).alias("to_object_id"), F.lit(label).alias("label"))
        for c, label in (("l_partkey", "part"), ("l_suppkey", "supplier"))
    ]
    responses = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_shipdate", F.array(*linked).alias("results")
    )
    parent_columns = {"l_orderkey": "id", "l_shipdate": "updated_at"}
    return explode_association(responses, "shop__orders", parent_columns, "results")


ROUTES = {"purchase": "sales", "signup": "accounts", "view": "traffic", "click": "traffic"}


@query(
    "route_by_key",
    """
    SELECT event_id,
           'app__' || CASE event_type WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'accounts'
                      WHEN 'view' THEN 'traffic' WHEN 'click' THEN 'traffic'
                      ELSE event_type END AS target
    FROM events
    """,
)
def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    return events.select("event_id", route_by_key("event_type", ROUTES, "app__").alias("target"))


@query(
    "route_tables",
    """
    SELECT event_id, value,
           'app__' || CASE event_type WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'accounts'
                      WHEN 'view' THEN 'traffic' WHEN 'click' THEN 'traffic'
                      ELSE event_type END AS table_name
    FROM events
    """,
)
def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows land in the table their key names; all tables are read back."""
    resource = Resource(
        name="app__mixed",
        selector="$",
        record=EVENTS.record,
        route_column="event_type",
        routes=ROUTES,
        route_prefix="app__",
    )
    store = RawStore(spark, shared_dir(spark, "route"))
    load_records(store, resource, given(spark, sf_dir, "events"), "run-1")
    tables = [
        store.read(t).select("event_id", "value", F.lit(t).alias("table_name"))
        for t in store.tables()
    ]
    result = tables[0]
    for table in tables[1:]:
        result = result.union(table)
    return result


@query(
    "route_tables_drift",
    """
    SELECT event_id,
           CASE WHEN event_id % 7 = 0 THEN 'app__unrouted'
                ELSE 'app__' || CASE event_type WHEN 'purchase' THEN 'sales'
                      WHEN 'signup' THEN 'accounts' WHEN 'view' THEN 'traffic'
                      WHEN 'click' THEN 'traffic' ELSE event_type END END AS table_name,
           CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS BIGINT) END AS whole,
           CASE WHEN event_id % 2 = 1 THEN value END AS fraction
    FROM events
    """,
)
def route_tables_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value column that is whole in one load and not in the next; some rows without a key."""
    resource = Resource(
        name="app__mixed",
        selector="$",
        record=EVENTS.record,
        route_column="event_type",
        routes=ROUTES,
        route_prefix="app__",
    )
    store = RawStore(spark, shared_dir(spark, "route-drift"))
    key = F.when(F.col("event_id") % 7 != 0, F.col("event_type"))
    events = given(spark, sf_dir, "events").withColumn("event_type", key)
    whole = events.filter("event_id % 2 = 0").withColumn("value", F.floor("value").cast("long"))
    load_records(store, resource, whole, "run-1")
    load_records(store, resource, events.filter("event_id % 2 = 1"), "run-2")
    tables = []
    for name in store.tables():
        table = store.read(name)
        empty = {c: F.lit(None).cast(t) for c, t in (("value", "long"), ("value__v_double", "double"))}
        table = table.withColumns({c: v for c, v in empty.items() if c not in table.columns})
        tables.append(
            table.select(
                "event_id",
                F.lit(name).alias("table_name"),
                F.col("value").alias("whole"),
                F.col("value__v_double").alias("fraction"),
            )
        )
    return union_all(*tables)


@query(
    "route_stream",
    """
    SELECT event_id, value,
           'app__' || CASE event_type WHEN 'purchase' THEN 'sales' WHEN 'signup' THEN 'accounts'
                      WHEN 'view' THEN 'traffic' WHEN 'click' THEN 'traffic'
                      ELSE event_type END AS table_name
    FROM events
    """,
)
def route_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of pages without declared fields, routed to tables batch by batch in two runs."""
    resource = Resource(
        name="app__streamed", selector="results", record=None, route_column="event_type", routes=ROUTES,
        route_prefix="app__",
    )
    events = given(spark, sf_dir, "events")
    folder = shared_dir(spark, "route-stream")
    store = RawStore(spark, f"{folder}/raw")
    for run, part in enumerate((F.col("ts") < HALF, F.col("ts") >= HALF)):
        _land(events.filter(part), f"{folder}/pages/{run}")
        stream_resource(
            store, resource, f"{folder}/pages/*", f"{folder}/checkpoint", multiline=False
        ).awaitTermination()
    tables = [
        store.read(t).select("event_id", F.col("value").cast("double").alias("value"), F.lit(t).alias("table_name"))
        for t in store.tables()
    ]
    return union_all(*tables)


@query(
    "page_explode_undeclared",
    """
    SELECT c_custkey AS id, c_mktsegment AS segment,
           CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS balance,
           CASE WHEN c_custkey % 2 = 0 THEN c_name END AS contact,
           CASE WHEN c_custkey % 2 = 1 THEN c_name END AS contact_name,
           CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END AS contact_nation
    FROM customer
    """,
)
def page_explode_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fields are declared; one more comes in some pages only, one is text in some and an object in others."""
    resource = Resource(name="shop__customers", selector="results", record="id bigint, segment string")
    odd = F.col("c_custkey") % 2 == 1
    nested = F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    rest = F.concat(
        F.lit('{"results":[{"contact":'),
        F.when(odd, F.to_json(nested)).otherwise(F.concat(F.lit('"'), "c_name", F.lit('"'))),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(',"balance":'), F.col("c_acctbal").cast("string"))).otherwise(F.lit("")),
        F.lit(',"id":'), F.col("c_custkey").cast("string"), F.lit(',"segment":"'), "c_mktsegment", F.lit('"}]}'),
    )
    folder = shared_dir(spark, "undeclared")
    given(spark, sf_dir, "customer").select(rest).write.text(f"{folder}/pages")
    store = RawStore(spark, f"{folder}/raw")
    load_resource(store, resource, f"{folder}/pages", "run-1", multiline=False)
    return store.read(resource.name).select(
        "id", "segment", F.col("balance").cast("double").alias("balance"), "contact",
        F.get_json_object("contact__v_json", "$.name").alias("contact_name"),
        F.get_json_object("contact__v_json", "$.nation").cast("bigint").alias("contact_nation"),
    )


@query(
    "row_hook",
    """
    SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS amount, json_extract(props, '$.k')::BIGINT AS k
    FROM events WHERE event_type <> 'error'
    """,
)
def row_hook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hook on the records drops some, makes a number of one field and takes another apart."""

    def amounts(records: DataFrame) -> DataFrame:
        parsed = F.from_json("props", "k bigint").getField("k")
        kept = records.filter("event_type <> 'error'")
        return kept.withColumns({"amount": F.floor("value").cast("bigint"), "k": parsed}).drop("value", "props")

    resource = Resource(name="app__hooked", selector="results", record=EVENTS.record, cursor="ts", transform=amounts)
    folder = shared_dir(spark, "hook")
    store = RawStore(spark, f"{folder}/raw")
    _land(given(spark, sf_dir, "events"), f"{folder}/pages")
    load_resource(store, resource, f"{folder}/pages", "run-1", multiline=False)
    return store.read(resource.name).select("event_id", "event_type", "amount", "k")


@query(
    "property_projection",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS props__k,
           CAST(NULL AS VARCHAR) AS props__absent
    FROM events
    """,
)
def property_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events").select("event_id", "props")
    return flatten(project_properties(events, "props", ("k", "absent")))[0]


@query(
    "load_audit",
    """
    SELECT conv_id, turn, role, 'load-' || version AS _load_id,
           md5(CAST(to_json({'conv_id': conv_id, 'role': role, 'text': text, 'turn': turn}) AS VARCHAR))
               AS _row_id
    FROM conversations CROSS JOIN (SELECT unnest([7, 8]) AS version) versions
    """,
)
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows keep their ids in a load whose schema has a new field, null in all of them, and another order."""
    first = given(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    second = first.select(F.lit(None).cast("string").alias("channel"), "text", "role", "turn", "conv_id")
    loads = [with_load_audit(first, "load-7"), with_load_audit(second, "load-8")]
    return union_all(*[df.select("conv_id", "turn", "role", "_load_id", "_row_id") for df in loads])
