"""Raw tables in small, with the edge cases the models must get right."""

from __future__ import annotations

from datetime import date, datetime

from tidemark.sources.schemas import RAW_TABLES, column_names

T0 = datetime(2025, 1, 1)
T1 = datetime(2025, 2, 1)


def page(page_id, day, flags, edited=T0, extra=()):
    """A habit page row in column order."""
    head = ["db", page_id, f'{{"start": "{day}"}}', page_id.title()]
    return (*head, *flags, *extra, T0, edited)


RAW_ROWS: dict[str, list[tuple]] = {
    "hubspot__companies": [
        (1, "Old name", T0, T0, "tier_3"),
        (1, "New name", T0, T1, "tier_1"),
        (2, "Beta", T0, T0, "tier_x"),
        (3, "Gamma", T0, T0, ""),
        (4, "Delta", T0, T0, None),
    ],
    "hubspot__contacts": [
        (10, 1, "a@example.org", "Ann", "A", T0, T0),
        (10, 1, "b@example.org", "Ann", "B", T0, T0),  # same time: greatest row wins
        (11, None, None, "Ben", "B", T0, T0),
        (12, 99, None, "Cid", "C", T0, T0),  # unknown company
    ],
    # Sunday 2025-08-03, Monday 2025-08-04
    "hubspot__meetings": [
        (100, "two people", datetime(2025, 8, 3, 23, 0), T0, T0),
        (101, "nobody", datetime(2025, 8, 4, 0, 0), T0, T0),
        (102, "one person", datetime(2025, 8, 4, 9, 0), T0, T0),
    ],
    "hubspot__calls": [
        (200, "one person", datetime(2025, 8, 6, 9, 0), T0, T0),
        (201, "stranger", datetime(2025, 8, 6, 9, 0), T0, T0),
        (102, "older twin of a meeting", datetime(2025, 8, 6, 9, 0), T0, datetime(2024, 1, 1)),
    ],
    "hubspot__communications": [(300, "mail", datetime(2025, 8, 6, 9, 0), T0, T0)],
    "hubspot__meetings_to_contacts": [
        (10, 100, T0), (11, 100, T0), (10, 102, T0), (10, 102, T1), (10, None, T0),
    ],
    "hubspot__calls_to_contacts": [(12, 200, T0), (999, 201, T0)],
    "hubspot__communications_to_contacts": [(10, 300, T0)],
    "fitbit__sleep": [
        (1, date(2025, 6, 6), 11_640_000, datetime(2025, 6, 5, 23, 17), datetime(2025, 6, 6, 2, 31), "classic", "manual"),
        (2, date(2025, 6, 7), 25_200_000, datetime(2025, 6, 7, 0), datetime(2025, 6, 7, 7), "classic", "auto"),
        (2, date(2025, 6, 6), 1, datetime(2025, 6, 7, 0), datetime(2025, 6, 7, 7), "classic", "auto"),
    ],
    "fitbit__activities": [
        (1, "2025-01-24T03:47:00.000-08:00", 4000, T0),
        (1, "2025-01-24T03:47:00.000-08:00", 4000, T0),  # delivered twice
        (2, "2025-01-24T23:59:00.000-08:00", 3500, T0),
        (3, "2025-01-25T08:00:00.000-08:00", None, T0),
    ],
    "notion__data_source_daily_habits": [
        page("d1", "2023-01-02", [True, True, True, False, False, None]),
        page("d2", "2023-01-08", [True, False, True, False, False, True]),
        page("d2", "2023-01-08", [False, False, False, False, False, True], datetime(2024, 1, 1)),
    ],
    "notion__data_source_weekly_habits": [
        page("w1", "2023-01-08", [True] * 7, extra=('{"number": 20.0}', 520)),
        page("w2", "2023-01-15", [False] * 7, extra=('{"number": null}', None)),
        page("w3", "2023-01-22", [None] * 7, extra=("{broken", 801)),
    ],
    "notion__data_source_monthly_habits": [page("m1", "2023-02-01T10:00:00", [True] * 5 + [False])],
    "notion__data_source_habit_reference": [],
}


def reference(row_id, name, kind, target, threshold=None, edited=T0):
    kind_json = None if kind is None else f'{{"name":"{kind}"}}'
    return (
        "db", row_id, name, '{"name":"Cat"}', '{"name":"Daily"}', kind_json, '{"name":"Notion"}',
        target, threshold, False, '{"checkbox":true}', '{"start": "2023-01-01"}', T0, edited,
    )


RAW_ROWS["notion__data_source_habit_reference"] = [
    reference("r1", "Prayer", "Tickbox", 80),
    reference("r1", "Prayer", "Tickbox", 10, edited=datetime(2024, 1, 1)),
    reference("r2", "Read Bible", "Tickbox", 50),
    reference("r3", "Meet 1to1", None, 100, threshold=3),
    reference("r4", "Sleep Minutes", "Number", 100),
]


def raw_frames(spark):
    frames = {}
    for name, rows in RAW_ROWS.items():
        order = column_names(name)
        frames[name] = spark.createDataFrame([fit(name, r) for r in rows], RAW_TABLES[name])
        assert frames[name].columns == order
    return frames


def fit(name, row):
    """Numbers of decimal columns as Decimal."""
    from decimal import Decimal

    kinds = [c.split(" ", 1)[1] for c in RAW_TABLES[name].split(", ")]
    return tuple(
        Decimal(v) if k.startswith("decimal") and v is not None else v
        for k, v in zip(kinds, row, strict=True)
    )
