from tidemark.operators.dedupe import latest_per_key
from tidemark.operators.intervals import interval_overlaps
from tidemark.operators.joins import (
    ALL,
    child_counts,
    frequent_keys,
    left_join_hot_right,
    orphan_keys,
    orphans,
    spread_join,
)
from tidemark.operators.reshape import (
    empty_relation,
    json_array_rows,
    route_by_key,
    union_all,
    union_by_name,
    unpivot_flags,
)
from tidemark.operators.spine import date_spine, gap_fill, gap_fill_by

__all__ = [
    "ALL",
    "child_counts",
    "date_spine",
    "empty_relation",
    "gap_fill",
    "gap_fill_by",
    "interval_overlaps",
    "json_array_rows",
    "latest_per_key",
    "frequent_keys",
    "left_join_hot_right",
    "orphan_keys",
    "orphans",
    "route_by_key",
    "spread_join",
    "union_all",
    "union_by_name",
    "unpivot_flags",
]
