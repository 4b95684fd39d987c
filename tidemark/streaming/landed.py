"""Incremental loads as a stream over the landing folder."""

from __future__ import annotations

from typing import Any

from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.load import load_stream, page_texts
from tidemark.sources.raw_store import RawStore
from tidemark.sources.resources import Resource


def stream_resource(
    store: RawStore,
    resource: Resource,
    landing: str,
    checkpoint: str,
    multiline: bool = True,
    files_per_batch: int | None = None,
    **options: Any,
) -> StreamingQuery:
    """Load whatever arrived since the last run, batch by batch, then stop.

    Pages are read as text and parsed to VARIANT, so a resource needs no declared
    fields; each batch finds its own. The checkpoint takes the place of the cursor.
    A batch that is run again has the same number, so the same load id, and
    replaces what its first try wrote. ``files_per_batch`` cuts a large backlog
    into batches of so many files.
    """
    limit = {"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}
    texts = page_texts(store.spark, landing, multiline, stream=True, maxFileAge="36500d", **limit)
    name = lambda number: f"{resource.name}-{number:012d}"
    return load_stream(store, resource, texts, checkpoint, name, incremental=False, **options)
