"""Scalar functions, all plain Column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that stands for null inside a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"



def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts as text, joined with '-', null parts marked.

    Pass literals with ``F.lit``. Use integer, text, boolean or date parts: the
    text form of a double differs between engines.
    """
    as_text = [F.coalesce(_col(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *as_text))


# A JSON string, taken as a whole so that nothing inside it counts as a field.
_JSON_STRING = r'"(?:[^"\\]++|\\.)*+"'


def canonical_json(value: Column) -> Column:
    """JSON text of a VARIANT that hangs on its fields alone.

    Names are sorted and null fields left out, so neither their order nor fields
    without a value, such as a schema may add, change it.
    """
    text = F.to_json(value)
    kept = F.regexp_replace(text, rf"{_JSON_STRING}:null(?:,|(?=\}}))|({_JSON_STRING})", "$1")
    kept = F.regexp_replace(kept, rf"({_JSON_STRING})|,(?=\}})", "$1")
    return F.when(F.contains(text, F.lit(":null")), kept).otherwise(text)


def _by_name(col: Column, kind: T.DataType) -> Column:
    """The value with the fields of its objects in the order of their names."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return F.when(
            col.isNotNull(), F.struct(*[_by_name(col.getField(f.name), f.dataType).alias(f.name) for f in fields])
        )
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(col, lambda x: _by_name(x, kind.elementType))
    return col


def row_hash(schema: T.StructType) -> Column:
    """Content hash of a whole row; equal rows get equal ids on every attempt.

    Taken of the row as JSON with sorted names and without null fields, in which no
    two rows look alike but for null fields and the order of columns.
    """
    fields = sorted(schema.fields, key=lambda f: f.name)
    row = F.struct(*[_by_name(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    return F.md5(F.to_json(row))


def safe_cast(c: Column | str, to: str) -> Column:
    """Cast, or null where the value does not fit."""
    return _col(c).try_cast(to)


def int_from_text(c: Column | str) -> Column:
    """Whole number from text such as '20' or '20.0', else null."""
    return F.round(_col(c).try_cast("double")).try_cast("int")


def last_char_as_int(c: Column | str) -> Column:
    """'tier_2' -> 2; anything whose last character is no digit -> null."""
    return F.right(_col(c).cast("string"), F.lit(1)).try_cast("int")


def json_value(c: Column | str, path: str) -> Column:
    """Scalar at a JSON path as text; null for missing paths and broken JSON."""
    return F.get_json_object(_col(c), path)


def json_length(c: Column | str) -> Column:
    """Number of items of a JSON array text; null for anything else."""
    return F.json_array_length(_col(c))


def trunc_date(part: str, c: Column | str) -> Column:
    """First day of the week (Monday), month, quarter or year; 'day' is the date."""
    as_date = _col(c).cast("date")
    return as_date if part.lower() == "day" else F.trunc(as_date, part)


def date_prefix(c: Column | str) -> Column:
    """Date in the first ten characters, as written (no time zone shift)."""
    return F.left(_col(c).cast("string"), F.lit(10)).try_cast("date")


def cursor_day(c: Column | str) -> Column:
    """Day part of a cursor value, as text."""
    return F.substring(_col(c).cast("string"), 1, 10)


def epoch_ms(c: Column | str) -> Column:
    """Milliseconds since 1970 of a timestamp or an ISO text."""
    return F.unix_millis(_col(c).try_cast("timestamp"))


def from_epoch_ms(c: Column | str) -> Column:
    return F.timestamp_millis(_col(c).cast("bigint"))


def epoch_ms_to_iso(c: Column | str) -> Column:
    """Milliseconds since 1970 as ISO text in UTC, with fraction only if there is one."""
    at = from_epoch_ms(c)
    whole = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    has_ms = F.pmod(_col(c).cast("bigint"), F.lit(1000)) != 0
    micros = F.when(has_ms, F.date_format(at, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(whole, micros, F.lit("+00:00"))


def completion_rate(done: Column | str, total: Column | str) -> Column:
    """done / total to four places; null when total is 0."""
    return F.round(_col(done).cast("double") / F.nullif(_col(total), F.lit(0)), 4)


def snake_key(c: Column | str) -> Column:
    """'Read Bible' -> 'read_bible'."""
    return F.lower(F.replace(_col(c), F.lit(" "), F.lit("_")))
