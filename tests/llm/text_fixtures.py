from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

ROWS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs; ``extra`` adds columns that clash with results."""

    def make(rows, extra=()):
        full = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, ROWS)
        return df.selectExpr("*", *[f"'x' AS `{c}`" for c in extra])

    return make


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
