"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def _sortable(field: T.StructField) -> str:
    unsorted = isinstance(field.dataType, (T.MapType, T.VariantType))
    return f"to_json(`{field.name}`)" if unsorted else f"`{field.name}`"


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: greatest ``order_by``, nulls last.

    Ties go to the greatest remaining columns, so the same rows give the same
    answer on every attempt. The rank filter lets Spark keep one row per key in
    each map task before the shuffle, which is what makes a key with a third of
    all rows harmless.
    """
    if tie_break is None:
        used = {*keys, *order_by}
        ties = [_sortable(f) for f in df.schema.fields if f.name not in used]
    else:
        ties = [f"`{c}`" for c in tie_break]
    order = ", ".join(f"{c} desc nulls last" for c in [*[f"`{c}`" for c in order_by], *ties])
    groups = ", ".join(f"`{c}`" for c in keys)
    rank = F.expr(f"row_number() over (partition by {groups} order by {order})")
    ranked = df.withColumn(_RANK, rank)
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)
