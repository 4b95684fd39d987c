"""Landed API pages: one JSON document per response."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import epoch_ms_to_iso

# Fixed value: extraction starts here unless told otherwise.
BASE_DATE = "2020-01-01"

WHOLE_DOCUMENT = "$"


def page_schema(record: T.StructType, selector: str) -> T.StructType:
    if selector == WHOLE_DOCUMENT:
        return record
    return T.StructType([T.StructField(selector, T.ArrayType(record))])


def page_records(df: DataFrame, column: str, record: T.StructType, selector: str) -> DataFrame:
    """Records of pages held as JSON text in a column."""
    page = F.from_json(F.col(column), page_schema(record, selector), {"mode": "FAILFAST"})
    pages = df.select(page.alias("page"))
    if selector == WHOLE_DOCUMENT:
        return pages.select("page.*")
    return pages.select(F.inline(F.col(f"page.{selector}")))


# --- records of any shape ---------------------------------------------------


def variant_records(pages: DataFrame, column: str, selector: str, keep: Mapping[str, str] | None = None) -> DataFrame:
    """Records (``record``, VARIANT) of pages held as VARIANT; ``keep`` takes page fields along by name."""
    page = F.col(column)
    kept = [F.variant_get(page, f"$.{f}", "string").alias(name) for f, name in (keep or {}).items()]
    if selector == WHOLE_DOCUMENT:
        return pages.select(*kept, page.alias("record"))
    records = F.variant_get(page, f"$.{selector}", "array<variant>")
    return pages.select(*kept, F.explode(records).alias("record"))


def found_schema(records: DataFrame) -> T.StructType:
    """Every field that the records hold, by one distributed pass that merges their schemas.

    Fields of one type have it, those of several are VARIANT, those that are
    always null are of type void.
    """
    text = records.agg(F.schema_of_variant_agg("record")).first()[0] or ""
    if not text.startswith("OBJECT"):
        return T.StructType()
    # Names in backticks stay as they are.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m.group(1) or "STRUCT<", text)
    return T.DataType.fromDDL(ddl)


def evolved(declared: T.DataType | None, found: T.DataType, in_list: bool = False) -> T.DataType | None:
    """The declared type with what else was found; None for what is always null.

    Declared fields keep their type and place, others follow. In lists, fields of
    several types are text.
    """
    if isinstance(found, T.StructType) and isinstance(declared, (T.StructType, type(None))):
        fields = {f.name: f.dataType for f in (declared.fields if declared else [])}
        for f in found.fields:
            kind = evolved(fields.get(f.name), f.dataType, in_list)
            if kind is not None:
                fields[f.name] = kind
        return T.StructType([T.StructField(n, k) for n, k in fields.items()]) if fields else None
    if isinstance(found, T.ArrayType) and isinstance(declared, (T.ArrayType, type(None))):
        item = evolved(declared.elementType if declared else None, found.elementType, True)
        return T.ArrayType(item or T.StringType())
    if declared is not None:
        return declared
    if isinstance(found, T.NullType):
        return None
    if isinstance(found, T.VariantType) and in_list:
        return T.StringType()
    if isinstance(found, T.DecimalType) and found.scale:
        return T.DoubleType()
    return found


def typed_records(records: DataFrame, declared: T.StructType | None) -> DataFrame:
    """Records as columns: the declared fields and all others that occur."""
    kind = evolved(declared or T.StructType(), found_schema(records))
    others = [c for c in records.columns if c != "record"]
    if kind is None:  # nothing is declared and nothing came
        return records.select(*others)
    typed = records.select(*others, F.col("record").cast(kind).alias("record"))
    return typed.select(*others, *[F.col("record").getField(f.name).alias(f.name) for f in kind.fields])


def date_window(
    df: DataFrame,
    cursor: str,
    start: Any = BASE_DATE,
    end: Any = None,
    include_start: bool = True,
    include_end: bool = True,
) -> DataFrame:
    """Rows whose cursor lies in the window; the comparison reaches the file scan."""
    kind = df.schema[cursor].dataType
    col, low = F.col(cursor), F.lit(start).cast(kind)
    condition = col >= low if include_start else col > low
    if end is not None:
        high = F.lit(end).cast(kind)
        condition = condition & (col <= high if include_end else col < high)
    return df.filter(condition)


def project_properties(
    df: DataFrame, column: str, properties: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Keep only the listed properties of an object column.

    The column may be an object or JSON text of one; sources deliver both. Text
    is parsed with just the wanted fields.
    """
    names = list(properties)
    if isinstance(df.schema[column].dataType, T.StringType):
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        parsed: Column = F.from_json(F.col(column), schema)
    else:
        have = {f.name for f in df.schema[column].dataType.fields}
        fields = [
            (F.col(f"{column}.{n}") if n in have else F.lit(None).cast("string")).alias(n)
            for n in names
        ]
        parsed = F.when(F.col(column).isNotNull(), F.struct(*fields))
    return df.withColumn(column, parsed)


def engagement_times_as_iso(df: DataFrame) -> DataFrame:
    """Records of the older engagement shape with ``lastUpdated`` as ISO text."""
    updated = epoch_ms_to_iso("engagement.lastUpdated")
    return df.withColumn("engagement", F.col("engagement").withField("lastUpdated", updated))


def explode_association(
    responses: DataFrame, parent: str, parent_columns: Mapping[str, str], children: str
) -> DataFrame:
    """Child rows of an association response with the parent's key columns.

    Column ``id`` of parent table ``crm__x`` appears as ``_crm__x_id``.
    """
    kept = [F.col(c).alias(f"_{parent}_{name}") for c, name in parent_columns.items()]
    return responses.select(*kept, F.inline(F.col(children)))
