"""Plans must keep the shape that scales."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import plan
from fixtures import raw_frames

import __spark_entry__ as spark_entry
from tidemark.plans.build import MODELS, build
from workload.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are not here")

# These load or write when called; their parts are planned by other queries.
EAGER = {
    "incremental_append", "incremental_append_stream", "full_refresh", "merge_upsert",
    "route_tables", "route_tables_drift", "route_stream", "page_explode_undeclared", "row_hook", "publish_table", "dq_report_on_write", "dq_model_suite", "csv_round_trip",
}
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "RoundRobin")


@given_tables
def test_no_nested_loops_and_no_python(spark):
    for name, query in QUERIES.items():  # without the text operators, which may use Python
        if name not in EAGER:
            text = plan(query(spark, SF_DIR))
            assert not [word for word in BANNED if word in text], name


@given_tables
def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark_entry.queries()["date_window_pull"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text
    text = plan(spark_entry.queries()["weekly_completion"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text


@given_tables
def test_metrics_read_each_source_as_often_as_needed(spark):
    """Meetings are left out of the weekly branch, weekly pages are unpivoted once."""
    text = plan(spark_entry.queries()["habits_metrics_v1"](spark, SF_DIR))
    assert text.count("FileScan") <= 16


def test_windows_of_models_are_limited_before_the_shuffle(spark):
    models = build(raw_frames(spark), [n for n in MODELS if n.startswith(("stg_", "base_"))])
    for name, df in models.items():
        text = plan(df)
        if "row_number()" in text:
            assert "row_number(), 1, Partial" in text, name


def test_the_join_chain_reads_each_source_once(spark):
    """Also where nothing fits a broadcast and keys are spread."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        frames = raw_frames(spark)
        text = plan(build(frames, ["engagement_contacts_v1"])["engagement_contacts_v1"])
    finally:
        spark.conf.set(name, before)
    scans = text.count("Scan ExistingRDD") + text.count("LocalTableScan")
    # Companies, contacts, three kinds of engagements and of links.
    assert scans == 8 and "BroadcastHashJoin" not in text and text.count("SortMergeJoin") == 3
