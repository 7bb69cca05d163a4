"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from checks.oracle import ORACLE
from checks.queries import QUERIES
from conftest import SF, bronze_of, ingest, record
from tidewell.operators import gold, merge, profile, ranges, silver
from tidewell.plans.clean_insert import _FILTER, HASH_FILTER
from tidewell.plans.silver import GOLD, run_silver
from tidewell.schemas import BRONZE, CLEAN_EVENTS, QUEUE
from tidewell.session import settings
from tidewell.sources.tables import read_incremental, shared_dir


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(lake):
    texts = [record(event_time=f"2024-01-01T{hour:02d}:00:00Z") for hour in range(6)]
    ingest(lake, texts, 0)
    ingest(lake, texts[:2], 1)
    run_silver(lake)
    return lake


def test_silver_reads_two_columns_of_the_new_snapshots(stored):
    text = plan(silver.distinct_contents(silver.silver_project(read_incremental(stored.read(BRONZE), 0, 1))))
    assert "ReadSchema: struct<kafka_timestamp:timestamp,raw_value:string>" in text
    assert re.search(r"PartitionFilters: \[.*snapshot_id#\d+L <= 1\), \(snapshot_id#\d+L > 0\)", text)
    assert text.count("from_json(") == 1 and text.count("Exchange") == 1
    assert "partial_min" in text


def test_gold_reads_only_the_queued_hours(stored):
    pending = stored.stage(ranges.pending_ranges(stored.read(QUEUE), GOLD), "ranges")
    events = ranges.in_ranges(stored.read(CLEAN_EVENTS), pending.limit(2))
    df = gold.combine(gold.windowed(gold.event_measures(events)), "start_time", "end_time")
    assert "dynamicpruning" in plan(df) and "BroadcastHashJoin" in plan(df)
    assert "product_id" not in plan(df)


def test_fixed_time_bounds_prune_directories(stored):
    bounds = (F.lit(f"2024-01-01 0{hour}:00:00").cast("timestamp") for hour in (1, 2))
    rows = ranges.time_range(stored.read(CLEAN_EVENTS), *bounds)
    assert re.search(r"PartitionFilters: \[.*p_hour#\d+L >= 473353\), \(p_hour#\d+L <= 473354\)", plan(rows))
    assert rows.count() == 1


def test_merge_reads_hashes_of_the_touched_hours(stored):
    hours = stored.stage(stored.read(CLEAN_EVENTS).limit(2).select("p_hour"), "hours")
    text = plan(ranges.in_hours(stored.read(CLEAN_EVENTS), hours).select("event_hash"))
    assert "ReadSchema: struct<event_hash:string>" in text and "dynamicpruning" in text


def test_stored_hashes_meet_a_filter_at_the_scan(stored):
    """Of hours whose stored hashes the batch does not have nothing gets past the filter to the shuffle."""
    batch = stored.stage(silver.silver_batch(bronze_of(stored.spark, [record(event_time=f"2024-01-01T0{h}:00:00Z", user_id="new") for h in range(3)])), "b")
    at_any_size = {f"{_FILTER}.applicationSideScanSizeThreshold": "0", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with settings(stored.spark, {**HASH_FILTER, **at_any_size}):
        known = merge.stored_keys(stored.read(CLEAN_EVENTS), batch, "event_hash")
        assert known.collect() == []
        text = plan(known)
        assert "might_contain" in text and "bloom_filter_agg" in text
        again = merge.stored_keys(stored.read(CLEAN_EVENTS), stored.read(CLEAN_EVENTS).limit(2), "event_hash")
        assert again.count() == 2


def test_profile_is_one_scan_without_joins(stored):
    text = plan(profile.user_profile(gold.event_measures(stored.read(CLEAN_EVENTS))))
    assert text.count("FileScan") == 1 and "Join" not in text and "Window" not in text


def test_no_gathering_windows_for_favorites_and_dedup(spark):
    events = silver.with_event_hash(silver.silver_project(bronze_of(spark, [record()])))
    for df in (profile.favorite_category(gold.event_measures(events)), silver.dedup_events(events)):
        assert "Window" not in plan(df)


LAZY = [
    "silver_clean", "quarantine_events", "dedup_events", "device_5min_summary", "user_activity_5min_summary",
    "user_profile", "merge_insert_clean", "repair_events", "schema_drift", "expired_snapshots", "orphan_files",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        if bad == "SinglePartition" and name == "schema_drift":
            continue  # one row of all keys is its meaning
        assert bad not in text, bad


def test_shared_folder_is_the_one_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == configured if configured else "tidewell" in shared_dir(spark)


def test_every_event_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())
