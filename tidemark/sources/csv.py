"""CSV files that mock raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import conform


# Text with line feeds in it can't be split, so one task reads a file: this bounds what it reads.
FILE_ROWS = 100_000


def write_csv(df: DataFrame, path: str, escape: str = '"', file_rows: int = FILE_ROWS) -> None:
    """A table as CSV with a header, in files of at most ``file_rows`` rows, however many a task has."""
    writer = df.write.option("header", True).option("escape", escape)
    writer.option("maxRecordsPerFile", file_rows).csv(path)


def read_csv(spark: SparkSession, path: str, table: str, escape: str = '"') -> DataFrame:
    """A raw table from CSV with a header.

    ``escape`` is how quotes inside quoted text are written: doubled ('"') or
    with a backslash. Every column is read as text, then cast to its type.
    """
    text = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", escape)
        .csv(path)
    )
    blank_to_null = [F.nullif(F.col(c), F.lit("")).alias(c) for c in text.columns]
    return conform(text.select(*blank_to_null), table)
