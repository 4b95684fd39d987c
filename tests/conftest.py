from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Write landed pages: ``land(resource, page, number)``; returns the folder."""

    def write(resource: str, page: dict, number: int = 1, indent: int | None = None) -> str:
        folder = tmp_path / "landing" / resource
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"page{number}.json").write_text(json.dumps(page, indent=indent, separators=None if indent else (",", ":")))
        return str(folder)

    return write


def rows(df, *columns):
    """All rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
