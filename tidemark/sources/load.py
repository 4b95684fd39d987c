"""From landed pages to raw tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import canonical_json, row_hash
from tidemark.operators.reshape import route_by_key
from tidemark.sources.nested import ROW_ID, exclude_fields, flatten, snake_case
from tidemark.sources.pages import BASE_DATE, date_window, project_properties, typed_records, variant_records
from tidemark.sources.raw_store import LOAD_ID, TARGET, RawStore
from tidemark.sources.resources import Resource
from tidemark.sources.schemas import schema_of

# Where rows without a route key go, behind the prefix of the resource.
UNROUTED = "unrouted"


PAGES = "_pages"


def page_texts(
    spark: SparkSession, path: str, multiline: bool = True, stream: bool = False, **options: Any
) -> DataFrame:
    """Pages as text: one document a file, or one a line with ``multiline=False``, which Spark can split."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    return reader.text(path, wholetext=multiline)


def land_pages(store: RawStore, resource: Resource, texts: DataFrame, load_id: str) -> None:
    """Pages parsed once and kept as VARIANT, in the partition of this load; a page that is no JSON stops the job."""
    pages = texts.filter(F.trim("value") != "").select(F.parse_json("value").alias("page"), F.lit(load_id).alias("load"))
    writer = pages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("load").parquet(f"{store.root}/{PAGES}/{resource.name}")


def landed_pages(store: RawStore, resource: Resource, load_id: str) -> DataFrame:
    """The pages of one load; no other partition is read."""
    pages = store.spark.read.schema("page variant, load string").parquet(f"{store.root}/{PAGES}/{resource.name}")
    return pages.filter(F.col("load") == load_id)


def landed_records(store: RawStore, resource: Resource, load_id: str) -> DataFrame:
    """Records of the landed pages, with all their fields, and the id of each.

    The id is taken of the record as it came, so it hangs neither on the declared
    fields nor on what other records hold.
    """
    keep = {}
    if resource.parent:
        keep = {"id": f"_{resource.parent}_id", "updatedAt": f"_{resource.parent}_updated_at"}
    records = variant_records(landed_pages(store, resource, load_id), "page", resource.selector, keep)
    content = F.to_variant_object(F.struct(*records.columns)) if keep else F.col("record")
    records = records.withColumn(ROW_ID, F.md5(canonical_json(content)))
    return typed_records(records, schema_of(resource.record) if resource.record else None)


def property_names(records: DataFrame, column: str = "properties") -> list[str]:
    """Every property that occurs: a pass over the pages, one value per name."""
    keys = records.select(F.explode(F.json_object_keys(column)).alias("name"))
    return sorted(r.name for r in keys.distinct().collect())


def _cursor_field(resource: Resource) -> str | None:
    if resource.parent and resource.cursor:
        return f"_{resource.parent}_{snake_case(resource.cursor)}"
    return resource.cursor


def _typed_cursor(name: str, kind: str) -> Column:
    missing = F.raise_error(F.lit(f"record without cursor {name}")).cast(kind)
    return F.coalesce(F.col(name).cast(kind), missing)


def with_load_audit(df: DataFrame, load_id: str) -> DataFrame:
    """Audit columns: which load brought the row, and an id made of its content."""
    if ROW_ID not in df.columns:
        df = df.withColumn(ROW_ID, row_hash(df.schema))
    return df.withColumn(LOAD_ID, F.lit(load_id))


def load_records(
    store: RawStore,
    resource: Resource,
    records: DataFrame,
    load_id: str,
    start: Any = BASE_DATE,
    end: Any = None,
    full_refresh: bool = False,
    incremental: bool = True,
    all_properties: bool = False,
) -> None:
    """Shape records and load them into the raw tables of the resource.

    ``full_refresh`` replaces the tables; otherwise the resource's own handling
    applies, and with ``incremental`` only records from the high-water mark on.
    """
    store.refresh()
    cursor = _cursor_field(resource)
    if resource.record is None and not set(records.columns) - {ROW_ID}:
        return  # no record came, and none is declared
    if ROW_ID not in records.columns:
        records = records.withColumn(ROW_ID, row_hash(records.schema))
    if cursor:
        records = records.withColumn(cursor, _typed_cursor(cursor, resource.cursor_type))
        records = date_window(
            records, cursor, start, end, resource.include_start, resource.include_end
        )
        flat_cursor = cursor if cursor.startswith("_") else snake_case(cursor)
        if incremental and not full_refresh:
            renamed = records.withColumnRenamed(cursor, flat_cursor)
            unseen = store.unseen(resource.name, renamed, flat_cursor, load_id)
            records = unseen.withColumnRenamed(flat_cursor, cursor)
    else:
        flat_cursor = None

    if resource.properties is not None:
        names = resource.properties
        if all_properties:
            names = tuple(dict.fromkeys([*names, *property_names(records)]))
        records = project_properties(records, "properties", names)
    if resource.exclude:
        records = exclude_fields(records, resource.exclude)
    if resource.transform:
        records = resource.transform(records)
    root, children = flatten(records, resource.max_nesting, resource.json_columns)
    casts = {c: F.col(c).cast(t) for c, t in resource.casts.items() if c in root.columns}
    root = with_load_audit(root.withColumns(casts), load_id)

    disposition = "replace" if full_refresh else resource.disposition
    if full_refresh and resource.disposition == "merge":
        # Resources that share a table: the first one replaces, the others merge.
        others = [r for r in store.loads(resource.target) if r.resource != resource.name]
        if any(r.load_id == load_id for r in others):
            disposition = "merge"
    # Children first: once the table itself has the load, the load is complete.
    for name, child in children.items():
        above = max((n for n in children if name.startswith(f"{n}__")), key=len, default=None)
        parent = f"{resource.target}__{above}" if above else resource.target
        write = store.replace if disposition == "replace" else store.append
        write(
            f"{resource.target}__{name}", child.withColumn(LOAD_ID, F.lit(load_id)), load_id,
            resource=resource.name, parent=parent if resource.disposition == "merge" else None,
        )
    if resource.route_column:
        name = route_by_key(resource.route_column, resource.routes, resource.route_prefix)
        name = F.coalesce(name, F.lit(f"{resource.route_prefix}{UNROUTED}"))
        # Table names keep letters, digits and underscores only.
        root = root.withColumn(TARGET, F.regexp_replace(name, "[^0-9A-Za-z_]+", "_"))
    if disposition == "merge":
        store.merge(
            resource.target, root, load_id, resource.keys, resource=resource.name, cursor=flat_cursor
        )
    else:
        write = store.replace if disposition == "replace" else store.append
        write(
            resource.target, root, load_id, flat_cursor, resource.name,
            target=TARGET if resource.route_column else None,
        )


def load_stream(
    store: RawStore,
    resource: Resource,
    texts: DataFrame,
    checkpoint: str,
    load_id: Callable[[int], str],
    **options: Any,
) -> StreamingQuery:
    """Land and load the pages that a text stream has not handed on yet, then stop.

    The stream's checkpoint remembers which files are done; it moves on when the
    raw tables have the batch. ``load_id`` names the load of a batch number.
    """

    def load(batch: DataFrame, number: int) -> None:
        name = load_id(number)
        if not store.committed(resource.name, resource.target, name):
            land_pages(store, resource, batch, name)
            load_records(store, resource, landed_records(store, resource, name), name, **options)

    writer = texts.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


# Files are new if the checkpoint does not name them, however old they are.
_ANY_AGE = {"maxFileAge": "36500d"}


def load_resource(
    store: RawStore,
    resource: Resource,
    path: str,
    load_id: str,
    multiline: bool = True,
    full_refresh: bool = False,
    **options: Any,
) -> bool:
    """Load the pages of a folder that no earlier load has read; False if there is no such folder.

    A full refresh reads all of them, and later loads what came after it. A load
    that is complete is not run again; one that failed leaves its pages to the next.
    """
    store.refresh()
    if store.committed(resource.name, resource.target, load_id):
        return True
    try:
        texts = page_texts(store.spark, path, multiline, stream=True, **_ANY_AGE)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    since = load_id if full_refresh else store.last_refresh(resource.name) or "first"
    first: list[int] = []

    def name(number: int) -> str:
        # A failed batch of an earlier run comes before what is new.
        first[:] = first or [number]
        return load_id if number == first[0] else f"{load_id}.{number - first[0]}"

    # A stream keeps its place in one folder.
    folder = hashlib.md5(str(path).encode()).hexdigest()[:12]
    checkpoint = f"{store.root}/_checkpoints/{resource.name}/{since}-{folder}"
    query = load_stream(store, resource, texts, checkpoint, name, full_refresh=full_refresh, **options)
    query.awaitTermination()
    return True


def load_all(
    store: RawStore,
    resources: Iterable[Resource],
    landing: str,
    load_id: str,
    **options: Any,
) -> None:
    """Load every resource that has pages in ``landing/<resource name>/``."""
    for resource in resources:
        load_resource(store, resource, f"{landing}/{resource.name}", load_id, **options)
