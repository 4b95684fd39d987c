from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import (
    child_counts,
    date_spine,
    empty_relation,
    gap_fill,
    interval_overlaps,
    json_array_rows,
    latest_per_key,
    ALL,
    frequent_keys,
    left_join_hot_right,
    orphan_keys,
    orphans,
    route_by_key,
    spread_join,
    union_all,
    union_by_name,
    unpivot_flags,
)

few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_latest_per_key_breaks_ties_and_puts_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, 5, "b"), (1, None, "z"), (2, None, "x"), (None, 1, "n"), (None, 0, "m")],
        "k int, at int, v string",
    )
    kept = latest_per_key(df, ["k"], ["at"])
    assert rows(kept) == sorted([(1, 5, "b"), (2, None, "x"), (None, 1, "n")], key=repr)
    # One row per key leaves each map task, however often the key occurs.
    assert "Partial" in plan(kept).split("Exchange")[1]


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), min_size=1))
def test_latest_per_key_against_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, at int, v int")
    expected = {k: max((a, v) for kk, a, v in data if kk == k) for k, _, _ in data}
    found = rows(latest_per_key(df, ["k"], ["at"]))
    assert found == sorted(((k, *v) for k, v in expected.items()), key=repr)


def test_left_join_hot_right_is_a_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, 1), (1, 2), (3, None), (None, 9), (4, 4)], "k int, r int")
    expected = rows(left.join(right, "k", "left").select("k", "l", "r"))
    assert rows(left_join_hot_right(left, right, ["k"]), "k", "l", "r") == expected


@pytest.fixture
def no_broadcast(spark):
    """As for a small side that is too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("frequent", [(), "found", ALL])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_the_plain_join(spark, no_broadcast, how, frequent):
    big = spark.range(200).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 9)
        .cast("int").alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    small = spark.createDataFrame([(1, "a"), (2, "b"), (50, "c"), (None, "d")], "k int, w string")
    keys = frequent_keys(big, ["k"], share=10)[0] if frequent == "found" else frequent
    joined = spread_join(big, small, ["k"], how, keys)
    text = plan(joined)
    assert text.count("SortMergeJoin") == 1 and text.count("Range (") == 1
    assert rows(joined) == rows(big.join(small, "k", how).select(*joined.columns))


def test_frequent_keys_are_found_in_one_pass(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("a"),
        F.when(F.col("id") % 20 == 1, F.lit(-1)).otherwise(F.col("id")).alias("b"),
    )
    a, b = frequent_keys(df, ["a"], ["b"])
    hashes = df.select(F.xxhash64(F.lit(None).cast("long")), F.xxhash64(F.lit(-1).cast("long"))).first()
    assert (a, b) == ([hashes[0]], [hashes[1]])
    assert frequent_keys(df.limit(0), ["a"]) == [[]]
    # All rows have keys of their own.
    assert frequent_keys(spark.range(50_000), ["id"]) == [[]]


@pytest.mark.parametrize("share", [1, 5, 1000])
def test_left_join_with_hot_right_keys(spark, no_broadcast, share):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(1, n) for n in range(9)] + [(3, 1), (4, 4), (None, 5)], "k int, r int")
    joined = left_join_hot_right(left, right, ["k"], frequent_keys(right, ["k"], share=share)[0])
    assert rows(joined, "k", "l", "r") == rows(left.join(right, "k", "left"), "k", "l", "r")


def test_orphans_too_many_to_broadcast(spark, no_broadcast):
    child = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    parent = spark.range(3)
    assert orphans(child, "k", parent, "id").count() == 70


def test_child_counts_ignore_null_children_and_keep_childless_parents(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    children = spark.createDataFrame([(1, 7), (1, None), (2, None), (None, 5)], "k int, c int")
    counted = child_counts(parents, children, "k", "c", "n")
    assert rows(counted) == [(1, 1), (2, 0), (3, 0)]


def test_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (9, "b"), (9, "c"), (None, "d")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert rows(orphans(child, "k", parent, "id")) == [(9, "b"), (9, "c")]
    assert rows(orphan_keys(child, "k", parent, "id")) == [(9, 2)]


def _overlaps_by_hand(logs):
    """Failing logs when sorted by start, then end."""
    ordered = sorted(logs)
    return sorted(
        (*a, b[0]) for a, b in zip(ordered, ordered[1:], strict=False) if a[1] > b[0]
    )


@few
@given(
    st.lists(
        st.tuples(st.integers(0, 400), st.integers(0, 300)).map(lambda p: (p[0], p[0] + p[1])),
        min_size=1,
        max_size=30,
    ),
    st.sampled_from([1, 60, 10_000]),
)
def test_interval_overlaps_against_brute_force(spark, logs, bucket):
    in_ms = [(a * 1000, b * 1000) for a, b in logs]
    df = spark.createDataFrame(in_ms, "a bigint, b bigint")
    found = interval_overlaps(df, "a", "b", bucket_seconds=bucket, share=100).collect()
    expected = _overlaps_by_hand(in_ms)
    assert sum(r.n_overlaps for r in found) == len(expected)
    assert {(r.a, r.b) for r in found} == {(a, b) for a, b, _ in expected}


@pytest.mark.parametrize("units", [1_000, 1_000_000])
def test_overlaps_across_days_and_units(spark, units):
    """The next start may lie days later; numbers count the declared unit."""
    hour = 3600 * units
    logs = [(0, 24 * 9 * hour), (23 * hour, 24 * hour), (24 * 8 * hour, 24 * 8 * hour + 1), (24 * 40 * hour, 24 * 41 * hour)]
    df = spark.createDataFrame([*logs, (None, 5)], "a long, b long")
    found = interval_overlaps(df, "a", "b", units_per_second=units)
    assert rows(found, "a", "next_start", "n_overlaps") == [(0, 23 * hour, 1)]
    longer = df.withColumn("b", F.when(F.col("a") > 0, 24 * 60 * hour).otherwise(F.col("b")))
    found = interval_overlaps(longer, "a", "b", units_per_second=units)
    assert sorted(rows(found, "a", "next_start")) == [
        (0, 23 * hour), (23 * hour, 24 * 8 * hour), (24 * 8 * hour, 24 * 40 * hour),
    ]
    assert interval_overlaps(df.limit(0), "a", "b").collect() == []


def test_interval_overlaps_per_entity(spark):
    t = datetime(2024, 1, 1)
    logs = [
        ("x", t, t + timedelta(hours=8)),
        ("x", t + timedelta(hours=8), t + timedelta(hours=9)),  # touches
        ("x", t + timedelta(hours=8, minutes=30), t + timedelta(hours=10)),  # overlaps
        ("y", t + timedelta(hours=1), t + timedelta(hours=2)),  # other entity
        ("z", t, t + timedelta(hours=9)),
        ("z", t + timedelta(hours=1), t + timedelta(hours=2)),  # nested
        ("z", None, t),
        ("q", t, t + timedelta(hours=1)),
        ("q", t, t + timedelta(hours=1)),  # equal
        (None, t, t + timedelta(hours=1)),
        (None, t + timedelta(minutes=5), None),
        (None, t + timedelta(minutes=30), t + timedelta(hours=2)),
    ]
    df = spark.createDataFrame(logs, "who string, a timestamp, b timestamp")
    found = interval_overlaps(df, "a", "b", ["who"])
    assert rows(found, "who", "n_overlaps") == [
        ("q", 1), ("x", 1), ("z", 1), (None, 1),
    ]


def test_unpivot_drops_null_flags_unless_told(spark):
    df = spark.createDataFrame([(1, True, None), (2, False, None)], "id int, a boolean, b boolean")
    assert rows(unpivot_flags(df, ["id"], ["a", "b"], "f", "v")) == [(1, "a", True), (2, "a", False)]
    kept = unpivot_flags(df, ["id"], ["a", "b"], "f", "v", keep_null=["b"])
    assert kept.count() == 4


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    assert rows(union_by_name(a, b)) == [(1, "x"), (2, "y")]
    c = spark.createDataFrame([(3,)], "id int")
    assert rows(union_by_name(a, c, fill_missing=True)) == [(1, "x"), (3, None)]
    empty = empty_relation(spark, "id int, v string")
    assert rows(union_all(a, empty)) == [(1, "x")]


def test_json_array_rows(spark):
    df = spark.createDataFrame([(1, '["a","b"]'), (2, "[]"), (3, None)], "id int, items string")
    assert rows(json_array_rows(df, "items", "item"), "id", "item") == [(1, "a"), (1, "b")]


def test_route_by_key(spark):
    df = spark.createDataFrame([("k1",), ("other",)], "k string")
    routed = df.select(route_by_key("k", {"k1": "one"}, "t_"))
    assert rows(routed) == [("t_one",), ("t_other",)]


def test_spine_end_is_exclusive(spark):
    spine = date_spine(spark)
    first, last, n = spine.agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert (first, last, n) == (date(2020, 1, 1), date(2030, 12, 30), 4017)
    assert date_spine(spark, "2024-01-01", "2024-01-01").count() == 0


def test_gap_fill(spark):
    daily = spark.createDataFrame([(date(2024, 1, 2), 5)], "d date, n int")
    filled = gap_fill(date_spine(spark, "2024-01-01", "2024-01-04"), daily, "d", ["n"])
    assert [r[1] for r in rows(filled)] == [0, 5, 0]


@pytest.mark.parametrize("share", [0.9])
def test_hot_keys_give_the_same_answer(spark, share):
    """One key holds most rows; results must not depend on it."""
    hot = F.when(F.rand(1) < share, 0).otherwise(F.col("id") % 50).cast("int")
    df = spark.range(20_000).select(hot.alias("k"), F.col("id").alias("at"))
    kept = latest_per_key(df, ["k"], ["at"])
    expected = df.groupBy("k").agg(F.max("at").alias("at"))
    assert rows(kept, "k", "at") == rows(expected, "k", "at")


def test_each_group_has_the_days_of_its_own_range(spark):
    from datetime import date

    from tidemark.operators import gap_fill_by

    day = lambda n: date(2024, 1, n)
    daily = spark.createDataFrame(
        [("a", day(1), 5), ("a", day(3), None), (None, day(9), 2), (None, day(10), 1), ("b", None, 7)],
        "k string, d date, n int",
    )
    assert rows(gap_fill_by(daily, "d", ["k"], ["n"])) == sorted(
        [("a", day(1), 5), ("a", day(2), 0), ("a", day(3), 0), (None, day(9), 2), (None, day(10), 1)], key=repr
    )
    assert gap_fill_by(daily.limit(0), "d", ["k"], ["n"]).count() == 0
