from tidemark.functions.columns import (
    canonical_json,
    completion_rate,
    cursor_day,
    date_prefix,
    epoch_ms,
    epoch_ms_to_iso,
    from_epoch_ms,
    int_from_text,
    json_length,
    json_value,
    last_char_as_int,
    row_hash,
    safe_cast,
    snake_key,
    surrogate_key,
    trunc_date,
)

__all__ = [
    "canonical_json",
    "completion_rate",
    "cursor_day",
    "date_prefix",
    "epoch_ms",
    "epoch_ms_to_iso",
    "from_epoch_ms",
    "int_from_text",
    "json_length",
    "json_value",
    "last_char_as_int",
    "row_hash",
    "safe_cast",
    "snake_key",
    "surrogate_key",
    "trunc_date",
]
