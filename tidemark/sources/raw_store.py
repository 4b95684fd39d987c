"""Raw tables on shared storage, with a record of every load.

A table that is appended to is one Parquet dataset partitioned by load; readers
ask for the loads that are in the record, so a job that dies half way leaves no
rows that anybody sees. A table that is merged into is one dataset partitioned by
a hash of its key, of which a merge overwrites the partitions it touches. Splitting
rows, pruning and overwriting partitions is all Spark's.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedupe import latest_per_key
from tidemark.session import written
from tidemark.sources.nested import LIST_INDEX, PARENT_ID, ROW_ID

LOAD_ID = "_load_id"
# Partition columns; readers don't see them.
RESOURCE, LOAD, TARGET, BUCKET = "_resource", "_load", "_table", "_bucket"

_LOADS = (
    "resource string, table_name string, load_id string, seq bigint, disposition string, "
    "path string, buckets int, parent string, routed boolean, "
    "n_rows bigint, cursor_max string, table_schema string, committed_at timestamp"
)


class RawStore:
    """``buckets`` key partitions for tables that are merged into; fixed for a table by its first merge."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._known: list[Row] | None = None

    # --- record of loads -------------------------------------------------

    def loads(self, table: str | None = None) -> list[Row]:
        """Committed loads in order. One small row per load, never data."""
        if self._known is None:
            self._known = self._read_loads()
        latest = {}
        for row in sorted(self._known, key=lambda r: (r.seq, r.committed_at)):
            latest[row.resource, row.table_name, row.load_id] = row
        return [r for r in latest.values() if table in (None, r.table_name)]

    def _read_loads(self) -> list[Row]:
        try:
            return self.spark.read.schema(_LOADS).json(f"{self.root}/_loads").collect()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise

    def refresh(self) -> None:
        """Look again for loads that other jobs committed."""
        self._known = None

    def _current(self, table: str) -> list[Row]:
        """Loads a reader sees: everything since the last replace."""
        ordered = sorted(self.loads(table), key=lambda r: r.seq)
        starts = [i for i, r in enumerate(ordered) if r.disposition == "replace"]
        return ordered[starts[-1] :] if starts else ordered

    def committed(self, resource: str, table: str, load_id: str) -> bool:
        return any(r.resource == resource and r.load_id == load_id for r in self.loads(table))

    def _commit(self, **entry) -> None:
        seq = 1 + max((r.seq for r in self.loads(entry["table_name"])), default=0)
        now = datetime.now(UTC).replace(tzinfo=None)
        schema = T.StructType.fromDDL(_LOADS)
        row = Row(**{f.name: None for f in schema.fields} | entry | {"seq": seq, "committed_at": now})
        values = [F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields]
        self.spark.range(0, 1, 1, 1).select(*values).write.mode("append").json(f"{self.root}/_loads")
        self._known = [*(self._known or []), row]

    def last_refresh(self, resource: str) -> str | None:
        """Id of the load that replaced the resource's tables last."""
        ids = [r.load_id for r in self.loads() if r.resource == resource and r.disposition == "replace"]
        return ids[-1] if ids else None

    # --- reading ---------------------------------------------------------

    def tables(self) -> list[str]:
        """Every table; those that rows were routed to are the partitions of their dataset."""
        routed = {r.table_name for r in self.loads() if r.routed}
        names = {r.table_name for r in self.loads()} - routed
        for dataset in routed:
            targets = self._appended(self._current(dataset)).select(TARGET).distinct()
            names |= {r[0] for r in targets.collect()}
        return sorted(names)

    def exists(self, table: str) -> bool:
        return bool(self._current(table))

    def schema(self, table: str) -> T.StructType | None:
        loads = self._current(table)
        return T.StructType.fromJson(json.loads(loads[-1].table_schema)) if loads else None

    def read(self, table: str) -> DataFrame:
        """The table; columns a load did not have yet are null in its rows.

        A table that rows were routed to has the columns of all that its resource sends.
        """
        self.refresh()
        if not self.exists(table):
            datasets = sorted({r.table_name for r in self.loads() if r.routed})
            parts = [self._appended(self._current(d)).filter(F.col(TARGET) == table) for d in datasets]
            parts = [p for p in parts if not p.isEmpty()]
            if not parts:
                raise KeyError(f"no load of {table}")
            found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            return found.drop(RESOURCE, LOAD, TARGET)
        loads = self._current(table)
        found = self._rows(loads)
        parents = {r.parent for r in loads if r.parent}
        for parent in parents:
            # Rows of parents that were replaced stay in the dataset and are passed over.
            alive = self.read(parent).select(F.col(ROW_ID).alias(PARENT_ID)).distinct()
            found = found.join(alive, PARENT_ID, "left_semi").select(*found.columns)
            found = latest_per_key(found, [PARENT_ID, LIST_INDEX], [LOAD_ID])
        return found

    def _rows(self, loads: Sequence[Row]) -> DataFrame:
        """What the loads hold: the merged dataset, and what was appended since."""
        schema = T.StructType.fromJson(json.loads(loads[-1].table_schema))
        merges = [r for r in loads if r.disposition == "merge"]
        later = [r for r in loads if not merges or r.seq > merges[-1].seq]
        parts = []
        if merges:
            parts.append(self.spark.read.schema(schema).parquet(merges[-1].path).drop(BUCKET))
        if later:
            parts.append(self._appended(later).drop(RESOURCE, LOAD))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def _appended(self, loads: Sequence[Row]) -> DataFrame:
        """Rows of appended loads of one table, with the partition columns."""
        schema = T.StructType.fromJson(json.loads(loads[-1].table_schema))
        partitions = [RESOURCE, LOAD, *([TARGET] if loads[-1].routed else [])]
        for name in partitions:
            schema = schema.add(name, T.StringType())
        ids: dict[str, list[str]] = {}
        for row in loads:
            ids.setdefault(row.resource, []).append(row.load_id)
        visible = [(F.col(RESOURCE) == name) & F.col(LOAD).isin(own) for name, own in sorted(ids.items())]
        dataset = self.spark.read.schema(schema).parquet(f"{self.root}/{loads[-1].table_name}")
        return dataset.filter(reduce(Column.__or__, visible))

    def high_water_mark(self, resource: str) -> str | None:
        """Greatest cursor loaded so far, as text."""
        marks = (r.cursor_max for r in self._resource_loads(resource))
        return max(marks, key=_cursor_order, default=None)

    def _resource_loads(self, resource: str) -> list[Row]:
        """Visible loads of a resource that carry its cursor, over all its tables."""
        tables = {r.table_name for r in self.loads() if r.resource == resource}
        visible = [r for t in sorted(tables) for r in self._current(t)]
        return [r for r in visible if r.resource == resource and r.cursor_max]

    def unseen(
        self, resource: str, df: DataFrame, cursor: str, load_id: str | None = None
    ) -> DataFrame:
        """Rows at or after the high-water mark that are not stored yet.

        Rows equal to the mark may be new or seen before; the stored rows at that
        one cursor value tell them apart by content. Rows of load ``load_id``
        itself do not count as stored, for a load that is run again.
        """
        loads = [r for r in self._resource_loads(resource) if r.load_id != load_id]
        if not loads:
            return df
        kind = df.schema[cursor].dataType
        mark = max((r.cursor_max for r in loads), key=_cursor_order)
        low = F.lit(mark).cast(kind)
        # Only loads that reach the mark can hold rows at it.
        at_mark = [r for r in loads if r.cursor_max == mark]
        found = self._rows(at_mark).filter(F.col(cursor) == low)
        seen = written(found.select(ROW_ID).distinct(), "seen-rows")
        # Ids hold the cursor value too, so ids of newer rows are not among them. Ids
        # are spread evenly; Spark broadcasts them if they are few.
        return df.filter(F.col(cursor) >= low).join(seen, ROW_ID, "left_anti").select(*df.columns)

    # --- writing ---------------------------------------------------------

    def append(
        self,
        table: str,
        df: DataFrame,
        load_id: str,
        cursor: str | None = None,
        resource: str | None = None,
        target: str | None = None,
        parent: str | None = None,
        disposition: str = "append",
    ) -> None:
        """Add a load. Written again under the same id it takes the place of what an unfinished try left.

        With ``target`` the rows go to the tables named in that column, each a
        partition of the dataset ``table``; the rows are written once for all
        targets, without a shuffle. With ``parent`` they are child rows of a table
        that is merged into, seen as long as their parent's row is there.
        """
        resource = resource or table
        if self.committed(resource, table, load_id):
            return
        old = self.schema(table) if disposition == "append" else None
        df = _evolve(df, old)
        marked = df.withColumns({RESOURCE: F.lit(resource), LOAD: F.lit(load_id)})
        path = f"{self.root}/{table}"
        facts = _observed_write(marked, cursor, path, [RESOURCE, LOAD, *([target] if target else [])])
        kept = T.StructType([f for f in df.schema.fields if f.name != target])
        self._commit(
            resource=resource, table_name=table, load_id=load_id, disposition=disposition, path=path,
            parent=parent, routed=bool(target), table_schema=_schema_text(merged_schema(old, kept)), **facts,
        )

    def replace(self, table: str, df: DataFrame, load_id: str, *args, **options) -> None:
        """Full refresh: readers switch to this load alone, and the cursor starts over."""
        self.append(table, df, load_id, *args, **options, disposition="replace")

    def merge(
        self,
        table: str,
        df: DataFrame,
        load_id: str,
        keys: Sequence[str],
        order_by: Sequence[str] = (),
        resource: str | None = None,
        cursor: str | None = None,
    ) -> None:
        """Upsert: incoming rows replace stored rows of the same key.

        With a ``cursor`` the newest of several incoming rows is taken, and it
        replaces no stored row that is newer. Only the key partitions that
        incoming rows fall into are read and overwritten; the first merge after
        appended or replaced rows takes these over.
        """
        resource = resource or table
        if self.committed(resource, table, load_id):
            return
        loads, old = self._current(table), self.schema(table)
        incoming = _evolve(latest_per_key(df, keys, order_by or ([cursor] if cursor else keys)), old)
        schema = merged_schema(old, incoming.schema)
        merges = [r for r in loads if r.disposition == "merge"]
        path = merges[-1].path if merges else f"{self.root}/_merged/{table}/{resource}-{load_id}"
        buckets = merges[-1].buckets if merges else self.buckets
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        incoming = incoming.withColumns({BUCKET: bucket, "_new": F.lit(True)})
        stored = []
        if merges:
            incoming = written(incoming, "merge-incoming")
            touched = [r[0] for r in incoming.select(BUCKET).distinct().collect()]  # at most ``buckets``
            with_bucket = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
            merged = self.spark.read.schema(with_bucket).parquet(path)
            stored.append(merged.filter(F.col(BUCKET).isin(touched)))
        later = [r for r in loads if not merges or r.seq > merges[-1].seq]
        if later:
            stored.append(self._rows(later).withColumn(BUCKET, bucket))
        for part in stored:
            incoming = incoming.unionByName(part.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        if stored:
            incoming = latest_per_key(incoming, keys, [*([cursor] if cursor else []), "_new"], tie_break=())
        # Files of even size, each of few buckets.
        result = incoming.select(*[f"`{c}`" for c in schema.names], BUCKET).hint("rebalance", BUCKET)
        facts = _observed_write(result, cursor, path, [BUCKET])
        self._commit(
            resource=resource, table_name=table, load_id=load_id, disposition="merge", path=path,
            buckets=buckets, routed=False, table_schema=_schema_text(schema), **facts,
        )

    def vacuum(self, table: str) -> list[str]:
        """Delete the folders of loads no reader sees any more."""
        current = self._current(table)
        merges = [r for r in current if r.disposition == "merge"]
        seen = {_folder(r) for r in current if r.disposition == "merge" or not merges or r.seq > merges[-1].seq}
        stale = sorted({_folder(r) for r in self.loads(table)} - seen)
        conf = self.spark._jsc.hadoopConfiguration()
        for path in stale:
            hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
        return stale


def _folder(load: Row) -> str:
    appended = f"{load.path}/{RESOURCE}={load.resource}/{LOAD}={load.load_id}"
    return load.path if load.disposition == "merge" else appended


def _observed_write(df: DataFrame, cursor: str | None, path: str, partition_by: Sequence[str]) -> dict:
    """Write partitions anew; rows and greatest cursor are counted on the way."""
    seen = Observation()
    top = F.max(cursor).cast("string") if cursor else F.max(F.lit(None).cast("string"))
    df = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), top.alias("cursor_max"))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)
    return seen.get


def _evolve(df: DataFrame, old: T.StructType | None) -> DataFrame:
    """A column whose type changed goes to a new column named after the type."""
    before = {f.name: f.dataType for f in (old.fields if old else [])}
    changed = {
        f.name: f"{f.name}__v_{f.dataType.typeName()}"
        for f in df.schema.fields
        if before.get(f.name, f.dataType) != f.dataType
    }
    return df.withColumnsRenamed(changed)


def _cursor_order(text: str) -> int | str:
    """Dates and timestamps in ISO form order as text, whole numbers do not."""
    return int(text) if text.lstrip("-").isdigit() else text


def merged_schema(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """Old columns first, then new ones; all nullable."""
    fields = {f.name: f for f in (old.fields if old else [])}
    for f in new.fields:
        fields.setdefault(f.name, f)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])


def _schema_text(schema: T.StructType) -> str:
    return json.dumps(schema.jsonValue())
