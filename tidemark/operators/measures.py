"""Measures and dimensions as grouped aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import trunc_date
from tidemark.operators.joins import frequent_keys, spread_join


@dataclass(frozen=True)
class Measure:
    """``agg`` is sum, count, average or count_distinct; ``where`` limits the rows it sees."""

    name: str
    agg: str
    expr: str
    where: str | None = None


@dataclass(frozen=True)
class Dimension:
    name: str
    expr: str
    is_time: bool = False


@dataclass(frozen=True)
class Entity:
    """Key of the model (``primary``, unique) or of another one (``foreign``)."""

    name: str
    expr: str
    primary: bool = False


@dataclass(frozen=True)
class SemanticModel:
    name: str
    entities: Sequence[Entity] = ()
    dimensions: Sequence[Dimension] = ()
    measures: Sequence[Measure] = ()

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)

    def key(self, name: str, primary: bool) -> Entity:
        return next(e for e in self.entities if e.name == name and e.primary == primary)

    def dimension(self, name: str) -> Column:
        """Column for 'name' or, for time dimensions, 'name__week' and coarser grains."""
        base, _, grain = name.partition("__")
        dim = next(d for d in self.dimensions if d.name == base)
        if not dim.is_time:
            return F.expr(dim.expr)
        return trunc_date(grain or "day", F.expr(dim.expr))

    def has_dimension(self, name: str) -> bool:
        return name.partition("__")[0] in {d.name for d in self.dimensions}


def measure(
    model: SemanticModel,
    df: DataFrame,
    names: Sequence[str],
    by: Sequence[str] = (),
    related: Mapping[str, tuple[SemanticModel, DataFrame]] | None = None,
) -> DataFrame:
    """Named measures grouped by dimensions, one row per combination.

    A dimension of another model is written 'entity__dimension' and found through
    ``related[entity]``. Additive measures are then summed per key before the
    join, so what is shuffled is one row per key and task, not the facts.
    """
    wanted = [model.measure(n) for n in names]
    local = [d for d in by if model.has_dimension(d)]
    foreign = [d for d in by if d not in local]
    entities = list(dict.fromkeys(d.partition("__")[0] for d in foreign))
    keys = {e: f"__{e}_key" for e in entities}

    # Measures of one expression read one input column. Together with FILTER this
    # keeps them in one distinct group: Spark expands the input once per column
    # counted, not once per measure.
    inputs = {e: f"__in{i}" for i, e in enumerate(dict.fromkeys(m.expr for m in wanted))}
    filters = {w: f"__if{i}" for i, w in enumerate(dict.fromkeys(m.where for m in wanted)) if w}
    base = df.select(
        *[model.dimension(d).alias(d) for d in local],
        *[F.expr(model.key(e, primary=False).expr).alias(k) for e, k in keys.items()],
        *[F.expr(e).alias(c) for e, c in inputs.items()],
        *[F.expr(w).alias(c) for w, c in filters.items()],
    )

    def whole(m: Measure) -> Column:
        return _aggregate(m, inputs[m.expr], filters.get(m.where))

    if not entities:
        return base.groupBy(*by).agg(*[whole(m).alias(m.name) for m in wanted])

    additive = all(m.agg != "count_distinct" for m in wanted)
    if additive:
        partial = [p for m in wanted for p in _partials(m, inputs[m.expr], filters.get(m.where))]
        base = base.groupBy(*local, *keys.values()).agg(*partial)
    for entity, key in keys.items():
        other, other_df = related[entity]
        mine = [d for d in foreign if d.partition("__")[0] == entity]
        looked_up = other_df.select(
            F.expr(other.key(entity, primary=True).expr).alias(key),
            *[other.dimension(d.partition("__")[2]).alias(d) for d in mine],
        )
        if additive:
            base = base.join(looked_up, key, "left")
        else:
            base = spread_join(base, looked_up, [key], frequent=frequent_keys(base, [key])[0])
    final = [(_merge(m) if additive else whole(m)).alias(m.name) for m in wanted]
    return base.groupBy(*by).agg(*final)


def _seen(column: str, condition: str | None) -> Column:
    return F.when(F.col(condition), F.col(column)) if condition else F.col(column)


def _aggregate(m: Measure, column: str, condition: str | None) -> Column:
    if m.agg == "count_distinct":
        suffix = f" filter (where {condition})" if condition else ""
        return F.expr(f"count(distinct {column}){suffix}")
    seen = _seen(column, condition)
    if m.agg == "average":
        return F.avg(seen.cast("double"))
    return {"sum": F.sum, "count": F.count}[m.agg](seen)


def _partials(m: Measure, column: str, condition: str | None) -> list[Column]:
    seen = _seen(column, condition)
    total = F.sum(seen.cast("double") if m.agg == "average" else seen)
    rows = F.count(seen)
    named = {"sum": total.alias(f"__{m.name}_sum"), "count": rows.alias(f"__{m.name}_n")}
    return list(named.values()) if m.agg == "average" else [named[m.agg]]


def _merge(m: Measure) -> Column:
    if m.agg == "sum":
        return F.sum(f"__{m.name}_sum")
    rows = F.sum(f"__{m.name}_n")
    if m.agg == "count":
        return F.coalesce(rows, F.lit(0).cast("bigint"))
    return F.sum(f"__{m.name}_sum") / F.nullif(rows, F.lit(0))


# --- approximate distinct counts, on request -------------------------------------

# Bits of a sketch's index: 2^14 registers, a standard error of 0.8 %.
SKETCH_BITS = 14


def distinct_sketches(
    model: SemanticModel, df: DataFrame, names: Sequence[str], time: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per day (and dimension values) with a sketch for each count_distinct measure.

    Sketches merge: coarser grains and totals come from these rows, without the
    facts. A day's sketch is made in each task and merged, whatever its rows.
    """
    wanted = [model.measure(n) for n in names]
    if any(m.agg != "count_distinct" for m in wanted):
        raise ValueError("only distinct counts are sketched")

    def counted(m: Measure) -> Column:
        # Text is a type that every kind of key has.
        value = F.expr(m.expr).cast("string")
        return F.when(F.expr(m.where), value) if m.where else value

    day = model.dimension(f"{time}__day").alias(f"{time}__day")
    facts = df.select(day, *[model.dimension(d).alias(d) for d in by], *[counted(m).alias(m.name) for m in wanted])
    sketches = [F.hll_sketch_agg(m.name, F.lit(SKETCH_BITS)).alias(m.name) for m in wanted]
    return facts.groupBy(f"{time}__day", *by).agg(*sketches)


def rolled_up(sketches: DataFrame, names: Sequence[str], time: str, grain: str, by: Sequence[str] = ()) -> DataFrame:
    """Approximate distinct counts per week, month, quarter or year of daily sketches."""
    period = trunc_date(grain, f"{time}__day").alias(f"{time}__{grain}")
    merged = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names]
    return sketches.groupBy(period, *by).agg(*merged)
