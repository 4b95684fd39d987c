"""Data checks. Each gives the failing rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import json_length
from tidemark.operators.intervals import interval_overlaps
from tidemark.operators.joins import orphan_keys, orphans
from tidemark.session import written

REPORT_SCHEMA = "model string, check string, target string, failures bigint, passed boolean"


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...]
    low: Any = None
    high: Any = None
    values: tuple = ()
    where: str | None = None
    parent: str | None = None
    field: str | None = None
    entity: tuple[str, ...] = ()

    @property
    def target(self) -> str:
        return ",".join(self.columns)


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", (c,)) for c in columns]


def unique(*columns: str) -> list[Check]:
    return [Check("unique", (c,)) for c in columns]


def compound_unique(*columns: str) -> list[Check]:
    return [Check("compound_unique", columns)]


def accepted_values(column: str, values: Sequence) -> list[Check]:
    return [Check("accepted_values", (column,), values=tuple(values))]


def between(column: str, low: Any, high: Any, where: str | None = None) -> list[Check]:
    return [Check("between", (column,), low=low, high=high, where=where)]


def array_length(column: str, low: int, high: int) -> list[Check]:
    return [Check("array_length", (column,), low=low, high=high)]


def relationships(column: str, to: str, field: str) -> list[Check]:
    return [Check("relationships", (column,), parent=to, field=field)]


def no_overlap(start: str, end: str, *entity: str) -> list[Check]:
    return [Check("no_overlap", (start, end), entity=entity)]


def _violation(check: Check, df: DataFrame) -> Column | None:
    """Condition a single failing row meets, for checks that look at one row."""
    col = F.col(check.columns[0])
    if check.kind == "not_null":
        return col.isNull()
    if check.kind == "accepted_values":
        return ~col.isin(list(check.values))
    if check.kind == "between":
        outside = ~col.between(F.lit(check.low), F.lit(check.high))
        return outside if check.where is None else outside & F.expr(check.where)
    if check.kind == "array_length":
        kind = df.schema[check.columns[0]].dataType.typeName()
        length = F.size(col) if kind == "array" else json_length(col)
        length = F.when(col.isNotNull(), length)
        return length.isNull() | (length < check.low) | (length > check.high)
    return None


def failing(
    df: DataFrame, check: Check, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows (or keys with their row counts, for uniqueness) that break the check."""
    condition = _violation(check, df)
    if condition is not None:
        return df.filter(condition)
    if check.kind in ("unique", "compound_unique"):
        present = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in check.columns])
        counts = df.filter(present).groupBy(*check.columns).agg(F.count("*").alias("n_records"))
        return counts.filter(F.col("n_records") > 1)
    if check.kind == "relationships":
        return orphans(df, check.columns[0], (tables or {})[check.parent], check.field)
    if check.kind == "no_overlap":
        return interval_overlaps(df, *check.columns, entity=check.entity)
    raise ValueError(f"unknown check {check.kind!r}")


def _failure_count(
    df: DataFrame, check: Check, tables: Mapping[str, DataFrame] | None
) -> DataFrame:
    if check.kind == "relationships":
        missing = orphan_keys(df, check.columns[0], (tables or {})[check.parent], check.field)
        return missing.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("failures"))
    bad = failing(df, check, tables)
    if check.kind == "no_overlap":
        return bad.agg(F.coalesce(F.sum("n_overlaps"), F.lit(0)).alias("failures"))
    return bad.agg(F.count("*").alias("failures"))


def _label(model: str, check: Check) -> dict[str, str]:
    """SQL text of the columns that name a check."""
    names = {"model": model, "check": check.kind, "target": check.target}
    return {column: f"'{name}'" for column, name in names.items()}


def report_one(
    df: DataFrame,
    model: str,
    checks: Sequence[Check],
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Failure count per check. All one-row checks share a single pass over the table."""
    local = [(c, v) for c, v in ((c, _violation(c, df)) for c in checks) if v is not None]
    parts = []
    if local:
        counts = [F.count_if(v).alias(f"c{i}") for i, (_, v) in enumerate(local)]
        failures = [(f"c{i}", c) for i, (c, _) in enumerate(local)]
        parts.append(df.agg(*counts).selectExpr(_counted(model, failures)))
    return _reported(parts, df, model, checks, tables)


def _counted(model: str, failures: Sequence[tuple[str, Check]]) -> str:
    """One row for each check whose number of failures an expression gives."""
    rows = []
    for count, check in failures:
        fields = {**_label(model, check), "failures": f"cast({count} as bigint)"}
        rows.append(f"struct({', '.join(f'{v} as `{k}`' for k, v in fields.items())})")
    return f"inline(array({', '.join(rows)}))"


def _reported(
    parts: list[DataFrame], df: DataFrame, model: str, checks: Sequence[Check], tables: Mapping[str, DataFrame] | None
) -> DataFrame:
    """The rows at hand, and those of the checks that look at more than one row."""
    for check in checks:
        if _violation(check, df) is None:
            counted = _failure_count(df, check, tables)
            label = [f"{text} as `{column}`" for column, text in _label(model, check).items()]
            parts = [*parts, counted.selectExpr(*label, "failures")]
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def written_with_report(
    df: DataFrame,
    model: str,
    checks: Sequence[Check],
    tables: Mapping[str, DataFrame] | None = None,
    cursor: str | None = None,
) -> tuple[DataFrame, DataFrame, dict]:
    """The table written and read back, its report, and its ``n_rows`` and ``cursor_max``.

    One-row checks, the rows and the greatest cursor are counted by the pass that
    writes; the other checks read what was written, so ``df`` is computed once.
    """
    local = [(c, v) for c, v in ((c, _violation(c, df)) for c in checks) if v is not None]
    seen = Observation()
    top = F.max(cursor) if cursor else F.max(F.lit(None).cast("string"))
    metrics = [F.count(F.lit(1)).alias("n_rows"), top.alias("cursor_max")]
    metrics += [F.count_if(v).alias(f"c{i}") for i, (_, v) in enumerate(local)]
    table = written(df.observe(seen, *metrics), model)
    found = seen.get
    parts = []
    if local:
        failures = [(str(found[f"c{i}"]), c) for i, (c, _) in enumerate(local)]
        parts.append(df.sparkSession.range(0, 1, 1, 1).selectExpr(_counted(model, failures)))
    facts = {name: found[name] for name in ("n_rows", "cursor_max")}
    return table, _reported(parts, table, model, checks, tables), facts


def report(
    tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Check]]
) -> DataFrame:
    """One row per check of every table in the suite."""
    parts = [report_one(tables[name], name, checks, tables) for name, checks in suite.items()]
    return reduce(DataFrame.unionByName, parts)
