"""Nested records: prune by path, flatten, keep as JSON, split into child tables.

All of it walks the schema on the driver and emits one ``select`` of Column
expressions; rows never meet Python.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import row_hash

ROW_ID = "_row_id"
PARENT_ID = "_parent_id"
LIST_INDEX = "_list_idx"


def snake_case(name: str) -> str:
    """'startTime' and 'Read Bible' -> 'start_time' and 'read_bible'."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()


# --- pruning by path -------------------------------------------------------


def _steps(path: str) -> list[tuple[bool, str]]:
    """'$.a..b' -> [(False, 'a'), (True, 'b')]; True means 'at any depth'."""
    found = re.findall(r"(\.\.?)([^.]+)", path.removeprefix("$"))
    if not found:
        raise ValueError(f"no field named in path {path!r}")
    return [(dots == "..", name) for dots, name in found]


class _Matcher:
    """The positions reached in each path while walking down a record."""

    def __init__(self, paths: Sequence[list[tuple[bool, str]]], at: frozenset | None = None):
        self.paths = paths
        self.at = frozenset((p, 0) for p in range(len(paths))) if at is None else at

    def enter(self, name: str) -> _Matcher | None:
        """Matcher below field ``name``, or None when a path ends on that field."""
        reached = set()
        for path, pos in self.at:
            any_depth, wanted = self.paths[path][pos]
            if any_depth:
                reached.add((path, pos))
            if wanted in ("*", name):
                if pos + 1 == len(self.paths[path]):
                    return None
                reached.add((path, pos + 1))
        return _Matcher(self.paths, frozenset(reached))

    def items(self) -> _Matcher:
        """Below an array only any-depth steps go on."""
        deep = frozenset((p, i) for p, i in self.at if self.paths[p][i][0])
        return _Matcher(self.paths, deep)


def _prune(col: Column, kind: T.DataType, match: _Matcher) -> tuple[Column | None, T.DataType]:
    """The value without the matched fields; None if nothing is left of it."""
    if not match.at:
        return col, kind
    if isinstance(kind, T.StructType):
        kept, fields = [], []
        for f in kind.fields:
            below = match.enter(f.name)
            if below is None:
                continue
            value, value_kind = _prune(col.getField(f.name), f.dataType, below)
            if value is not None:
                kept.append(value.alias(f.name))
                fields.append(T.StructField(f.name, value_kind))
        if not fields:
            return None, kind
        pruned = T.StructType(fields)
        if pruned.simpleString() == kind.simpleString():
            return col, kind
        return F.when(col.isNotNull(), F.struct(*kept)), pruned
    if isinstance(kind, T.ArrayType):
        below = match.items()
        _, item_kind = _prune(F.lit(None), kind.elementType, below)
        value, _ = _prune(F.col("x"), kind.elementType, below)
        if value is None:
            return None, kind
        if item_kind.simpleString() == kind.elementType.simpleString():
            return col, kind
        pruned = F.transform(col, lambda x: _prune(x, kind.elementType, below)[0])
        return pruned, T.ArrayType(item_kind)
    return col, kind


def exclude_fields(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Drop every field a path names: '$.a.b', '$.a.*.b', '$..b' or '$.a..b'."""
    match = _Matcher([_steps(p) for p in paths])
    columns = []
    for f in df.schema.fields:
        below = match.enter(f.name)
        if below is None:
            continue
        value, _ = _prune(F.col(f"`{f.name}`"), f.dataType, below)
        if value is not None:
            columns.append(value.alias(f.name))
    return df.select(*columns)


# --- flattening ------------------------------------------------------------


@dataclass
class _Flat:
    columns: list[tuple[str, Column]] = field(default_factory=list)
    lists: list[tuple[str, Column, T.DataType, int]] = field(default_factory=list)


def _walk(
    name: str, col: Column, kind: T.DataType, level: int, limit: int, as_json: set[str], out: _Flat
) -> None:
    nested = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
    if isinstance(kind, T.VariantType):
        # Of several types: plain values as text, objects and lists as JSON beside them.
        is_json = F.schema_of_variant(col).rlike("^(OBJECT|ARRAY)<")
        out.columns.append((name, F.when(~is_json, col.cast("string"))))
        out.columns.append((f"{name}__v_json", F.when(is_json, F.to_json(col))))
    elif not nested:
        out.columns.append((name, col))
    elif name in as_json or level >= limit or isinstance(kind, T.MapType):
        out.columns.append((name, F.to_json(col)))
    elif isinstance(kind, T.StructType):
        for f in kind.fields:
            below = f"{name}__{snake_case(f.name)}"
            _walk(below, col.getField(f.name), f.dataType, level + 1, limit, as_json, out)
    else:
        out.lists.append((name, col, kind.elementType, level + 1))


def flatten(
    df: DataFrame, max_nesting: int = 1000, json_columns: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Flat root table and one child table per list.

    Objects become ``a__b`` columns with snake-case names. Objects and lists that
    lie ``max_nesting`` levels deep, and the named columns, stay as JSON text. A
    child row carries the parent's row id and its place in the list. Row ids are
    content hashes, so parent and child agree when a task is run again. A VARIANT
    column, of several types, becomes ``a`` (plain values as text) and ``a__v_json``.
    """
    out = _Flat()
    for f in df.schema.fields:
        # Names that start with an underscore are bookkeeping and stay as they are.
        name = f.name if f.name.startswith("_") else snake_case(f.name)
        _walk(name, F.col(f"`{f.name}`"), f.dataType, 0, max_nesting, set(json_columns), out)
    if not out.lists:
        return df.select(*[c.alias(n) for n, c in out.columns]), {}

    source = df if ROW_ID in df.columns else df.withColumn(ROW_ID, row_hash(df.schema))
    columns = [(n, c) for n, c in out.columns if n != ROW_ID]
    root = source.select(*[c.alias(n) for n, c in columns], ROW_ID)
    children: dict[str, DataFrame] = {}
    for name, col, item, level in out.lists:
        items = source.select(
            F.col(ROW_ID).alias(PARENT_ID), F.posexplode(col).alias(LIST_INDEX, "value")
        )
        children |= _child(name, items, item, max(max_nesting - level, 0), json_columns)
    return root, children


def _child(
    name: str, items: DataFrame, item: T.DataType, nesting: int, json_columns: Sequence[str]
) -> dict[str, DataFrame]:
    if isinstance(item, T.StructType):
        items = items.select(PARENT_ID, LIST_INDEX, "value.*")
    root, below = flatten(items, nesting, json_columns)
    return {name: root} | {f"{name}__{n}": df for n, df in below.items()}
