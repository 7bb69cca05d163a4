"""Whole jobs over a small store."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import bronze_of, ingest, record, text_of, topic_of
from tidewell.operators import gold, maintenance, profile, ranges, silver
from tidewell.plans import maintenance as maintenance_jobs
from tidewell.plans.backfill import BACKFILL, run_backfill
from tidewell.plans.gold import queue_state, run_gold
from tidewell.plans.maintenance import (
    compact,
    compaction_report,
    delete_files,
    expire_snapshots,
    list_files,
    live_snapshots,
    stale_staging,
    table_files,
    unreferenced_files,
)
from tidewell.plans.quality import run_quality
from tidewell.plans.replay import run_replay
from tidewell.plans.silver import GOLD, run_silver
from tidewell.schemas import (
    BACKFILL_DATASETS,
    BAD_EVENTS,
    BRONZE,
    CHANGES,
    CLEAN_EVENTS,
    DRIFT,
    LOAD,
    METRICS,
    QUALITY,
    QUEUE,
    REPLAYS,
    RULES,
    SNAPSHOTS,
    STATE,
    TABLES,
    USER_PROFILE,
)
from tidewell.sources.tables import Lake, read_incremental
from tidewell.sources.topic import file_source
from tidewell.streaming.ingest import BronzeSink, start_bronze

RULE_ROWS = [
    ("invalid_event_type", "view", True, True),
    ("price_is_negative", "abs", True, True),
    ("event_time_is_null", "kafka_timestamp", True, True),
]


def add_rules(lake):
    lake.append(lake.spark.createDataFrame(RULE_ROWS, TABLES[RULES].schema), RULES)


def hour_record(hour, minute=0, **changes):
    return record(event_time=f"2024-01-01T{hour:02d}:{minute:02d}:00Z", **changes)


def test_every_table_reads_empty_before_its_first_write(lake):
    for name, table in TABLES.items():
        rows = lake.read(name)
        hidden = {LOAD, "snapshot_id"} if name == USER_PROFILE else {LOAD}
        assert rows.isEmpty() and set(rows.columns) == set(table.full_schema.names) - hidden


def test_nothing_to_do(lake):
    assert not run_silver(lake) and not run_gold(lake) and not run_replay(lake, "b")
    assert run_quality(lake).isEmpty()


def test_incremental_runs(lake):
    ingest(lake, [hour_record(10), hour_record(10), hour_record(11, price=-1)], 0)
    assert run_silver(lake) and not run_silver(lake)
    ingest(lake, [hour_record(10), hour_record(12)], 1)
    ingest(lake, [hour_record(13)], 2)
    assert run_silver(lake)
    assert text_of(lake.read(CLEAN_EVENTS), "event_time") == [(f"2024-01-01 {hour}:00:00",) for hour in (10, 12, 13)]
    counts = ("snapshot_id", "total_count", "valid_count", "bad_count", "duplicate_removed_count")
    assert text_of(lake.read(QUALITY), *counts) == [("0", "3", "1", "1", "1"), ("2", "3", "3", "0", "0")]
    assert text_of(lake.read(STATE), "last_snapshot_id") == [("0",), ("2",)]
    # hour 10 is queued again although the merge skipped its row
    assert text_of(lake.read(QUEUE), "start_time")[:2] == [("2024-01-01 10:00:00",)] * 2


def test_empty_snapshot_moves_the_state_only(lake):
    ingest(lake, [], 0)
    assert run_silver(lake) and not run_silver(lake)
    assert lake.read(QUALITY).isEmpty() and lake.read(STATE).count() == 1


def test_uncommitted_snapshot_is_not_read(lake):
    ingest(lake, [hour_record(10)], 0)
    lake.write_snapshot(bronze_of(lake.spark, [hour_record(11)]).withColumn("snapshot_id", F.lit(1)), BRONZE)
    run_silver(lake)
    assert lake.read(CLEAN_EVENTS).count() == 1


def test_repeating_a_batch_leaves_the_clean_table_unchanged(lake):
    texts = [hour_record(10, user_id=f"u_{n}") for n in range(5)]
    for snapshot_id in range(2):
        ingest(lake, texts, snapshot_id)
        run_silver(lake)
    assert lake.read(CLEAN_EVENTS).count() == 5


def test_drift_and_requests_once_per_key(lake):
    ingest(lake, [record(coupon="x")], 0)
    run_silver(lake)
    ingest(lake, [record(coupon="y", campaign="z", user_id="u_2")], 1)
    run_silver(lake)
    ingest(lake, [record(device=..., user_id="u_3")], 2)
    run_silver(lake)
    assert text_of(lake.read(CHANGES), "column_name", "status") == [("campaign", "pending"), ("coupon", "pending")]
    found = lake.read(DRIFT).select(F.array_join("new_columns", ",").alias("n"))
    assert text_of(found) == [("campaign,coupon",), ("coupon",)]


def test_gold_follows_late_data_and_touches_no_other_hour(lake):
    ingest(lake, [hour_record(10), hour_record(12)], 0)
    run_silver(lake)
    assert run_gold(lake) and not run_gold(lake)
    before = {row.path for row in list_files(lake, "gold/event_type_5min_count").collect()}
    ingest(lake, [hour_record(10, 1, user_id="late")], 1)
    run_silver(lake)
    assert run_gold(lake)
    after = {row.path for row in list_files(lake, "gold/event_type_5min_count").collect()}
    hour_12 = {path for path in before if f"p_hour={473364}" in path}
    assert len(hour_12) == 1 and hour_12 <= after and len(before & after) == 1
    assert text_of(lake.read("gold.event_type_5min_count"), "window_start", "count") == [
        ("2024-01-01 10:00:00", "2"),
        ("2024-01-01 12:00:00", "1"),
    ]
    assert text_of(lake.read(USER_PROFILE), "user_id", "total_view") == [("late", "1"), ("u_1", "2")]
    assert ranges.pending_ranges(queue_state(lake), GOLD).isEmpty()


def test_gold_equals_direct_aggregates(lake):
    kinds = ("view", "click", "purchase", "add_to_cart", "INVALID_EVENT")
    texts = [
        hour_record(
            9 + n % 4,
            n % 60,
            user_id=f"u_{n % 7}",
            event_type=kinds[n % 5],
            category=None if n % 3 == 0 else f"c_{n % 2}",
            device=None if n % 4 == 0 else "web",
            price=n - 5,
        )
        for n in range(150)
    ]
    ingest(lake, texts, 0)
    add_rules(lake)
    run_silver(lake)
    run_gold(lake)
    run_replay(lake, "b")
    run_gold(lake)
    clean = lake.read(CLEAN_EVENTS)
    assert clean.count() == 150
    measures = gold.event_measures(clean)
    for dataset, table in gold.WINDOW_TABLES.items():
        expected = table(gold.windowed(measures))
        assert text_of(lake.read(f"gold.{dataset}"), *expected.columns) == text_of(expected)
    expected = profile.user_profile(measures)
    assert text_of(lake.read(USER_PROFILE), *expected.columns) == text_of(expected)


def test_replay(lake):
    texts = [record(user_id="a", price=-5), record(user_id="b", price=None), record(user_id="c", event_time=None)]
    ingest(lake, texts, 0)
    add_rules(lake)
    run_silver(lake)
    assert run_replay(lake, "first") and not run_replay(lake, "second")
    assert text_of(lake.read(CLEAN_EVENTS), "user_id", "price") == [("a", "5"), ("b", None), ("c", "100")]
    assert text_of(lake.read(BAD_EVENTS), "user_id", "is_replayed", "replay_batch_id") == [
        (user, "true", "first") for user in "abc"
    ]
    summary = ("source_error_reason", "candidate_count", "repaired_count", "skipped_count")
    assert text_of(lake.read(REPLAYS), *summary) == [
        ("event_time_is_null", "1", "1", "0"),
        ("price_is_negative", "1", "1", "0"),
        ("price_is_null", "1", "1", "0"),
    ]


def test_strict_replay_keeps_what_it_cannot_repair(lake):
    ingest(lake, [record(user_id="a", price=-5), record(user_id="b", price=None)], 0)
    add_rules(lake)
    run_silver(lake)
    run_replay(lake, "first", strict=True)
    assert text_of(lake.read(CLEAN_EVENTS), "user_id") == [("a",)]
    assert text_of(lake.read(BAD_EVENTS), "user_id", "is_replayed") == [("a", "true"), ("b", "false")]


def test_replayed_events_without_time_count_in_the_profile(lake):
    """Without a rule for missing times such rows go back as they are: in no window, but in the profile."""
    ingest(lake, [record(), record(event_time=None, user_id="u_2")], 0)
    run_silver(lake)
    run_replay(lake, "b")
    run_replay(lake, "b")
    run_gold(lake)
    assert lake.read(CLEAN_EVENTS).filter("event_time is null").count() == 1
    assert text_of(lake.read("gold.event_type_5min_count"), "count") == [("1",)]
    assert text_of(lake.read(USER_PROFILE), "user_id", "total_view") == [("u_1", "1"), ("u_2", "1")]
    # the same event without a time again is not inserted twice
    ingest(lake, [record(event_time=None, user_id="u_2")], 1)
    run_silver(lake)
    run_replay(lake, "c")
    assert lake.read(CLEAN_EVENTS).count() == 2
    assert text_of(lake.read(BAD_EVENTS), "replay_batch_id") == [("c",), ("c",)]


def test_quality_metrics_and_alert(lake):
    ingest(lake, [record(), record(), record(price=-1)], 0)
    run_silver(lake)
    alerts = run_quality(lake)
    assert "Bad Rate: 33.33%" in alerts.first().message
    assert text_of(lake.read(METRICS), "snapshot_id", "total_count") == [("0", "3")]


def test_backfill(lake):
    rows = gold.windowed(gold.event_measures(silver.split_valid(silver.silver_batch(
        bronze_of(lake.spark, [hour_record(9), hour_record(10), hour_record(11)])))))
    source = f"{lake.root}/datasets"
    by_hour = [F.date_format("window_start", "yyyy-MM-dd").alias("dt"), F.date_format("window_start", "HH").alias("hour")]
    for dataset in BACKFILL_DATASETS:
        gold.WINDOW_TABLES[dataset](rows).select("*", *by_hour).write.partitionBy("dt", "hour").parquet(f"{source}/{dataset}")
    queue = ranges.affected_hours(lake.spark.sql("SELECT explode(array(timestamp'2024-01-01 09:00:00', timestamp'2024-01-01 11:30:00')) AS event_time"), BACKFILL)
    lake.append(queue.withColumn("updated_at", F.current_timestamp()), QUEUE)
    assert run_backfill(lake, source) and not run_backfill(lake, source)
    for dataset in BACKFILL_DATASETS:
        assert text_of(lake.read(f"gold_backfill.{dataset}"), "dt", "hour") == [("2024-01-01", "09"), ("2024-01-01", "11")]


def test_backfill_of_long_ranges_and_absent_hours(lake):
    rows = gold.windowed(gold.event_measures(silver.split_valid(silver.silver_batch(
        bronze_of(lake.spark, [hour_record(9), hour_record(10), hour_record(11)])))))
    source = f"{lake.root}/datasets"
    by_hour = [F.date_format("window_start", "yyyy-MM-dd").alias("dt"), F.date_format("window_start", "HH").alias("hour")]
    for dataset in BACKFILL_DATASETS:
        gold.WINDOW_TABLES[dataset](rows).select("*", *by_hour).write.partitionBy("dt", "hour").parquet(f"{source}/{dataset}")
    queue = lake.spark.sql("""
        SELECT 'other' AS pipeline_name, timestamp'2024-01-01 09:00:00' AS start_time, timestamp'2024-01-01 12:00:00' AS end_time
        UNION ALL SELECT 'other', timestamp'2024-01-01 11:00:00', timestamp'2024-01-01 14:00:00'""")
    lake.append(queue.withColumns({"processed": F.lit(False), "updated_at": F.current_timestamp()}), QUEUE)
    with pytest.raises(ValueError, match="hour=12"):
        run_backfill(lake, source, "other")
    for dataset in BACKFILL_DATASETS:
        assert text_of(lake.read(f"gold_backfill.{dataset}"), "hour") == [("09",), ("10",), ("11",)]
    with pytest.raises(ValueError):  # the range with absent hours is still queued
        run_backfill(lake, source, "other")


def test_stream_goes_on_after_bronze_compaction(lake, tmp_path):
    """Sink, silver, compaction, silver, sink, silver: no batch is missed."""
    topic_rows = topic_of(lake.spark, [record(user_id="x")])
    topic, checkpoint = f"file://{tmp_path}/topic", f"file://{tmp_path}/checkpoint"
    for batch in range(3):
        texts = [record(user_id=f"b{batch}_{n}") for n in range(4)]
        topic_of(lake.spark, texts).repartition(3).write.mode("append").parquet(topic)
        stream = lake.spark.readStream.schema(topic_rows.schema).parquet(topic)
        query = start_bronze(stream, lake, checkpoint, {"availableNow": True})
        query.awaitTermination()
        run_silver(lake)
        if batch == 0:
            assert compact(lake, BRONZE) and not run_silver(lake)
    assert lake.read(CLEAN_EVENTS).count() == 12
    assert lake.commits(BRONZE).select("snapshot_id").distinct().count() == lake.commits(BRONZE).count()
    with pytest.raises(ValueError):
        lake.append(bronze_of(lake.spark, [record()]), BRONZE)
    lake.commit(BRONZE, 5, "append"), lake.commit(BRONZE, 5, "append")
    with pytest.raises(ValueError):
        run_silver(lake)


def test_appends_during_compaction_and_replay_stay(lake, monkeypatch):
    for snapshot_id in range(2):
        ingest(lake, [hour_record(10, snapshot_id, user_id=f"u_{n}") for n in range(3)] + [hour_record(10, user_id=f"bad_{snapshot_id}", price=-1)], snapshot_id)
        run_silver(lake)
    add_rules(lake)
    ingest(lake, [hour_record(10, 30, user_id=f"late_{n}") for n in range(3)] + [hour_record(10, 31, user_id="late_bad", price=-1)], 2)
    stage, runs = type(lake).stage, []

    def with_silver(self, df, purpose, *partitions):
        out = stage(self, df, purpose, *partitions)
        if purpose in ("compaction", "replay") and len(runs) < 1:
            runs.append(purpose)
            run_silver(self)
        return out

    monkeypatch.setattr(type(lake), "stage", with_silver)
    assert compact(lake, CLEAN_EVENTS)
    assert runs == ["compaction"] and lake.read(CLEAN_EVENTS).count() == 9
    runs.clear()
    ingest(lake, [hour_record(10, 40, user_id="later_bad", price=-1)], 3)
    run_replay(lake, "b")
    assert runs == ["replay"] and lake.read(BAD_EVENTS).count() == 4
    assert text_of(lake.read(BAD_EVENTS).filter("not is_replayed"), "user_id") == [("later_bad",)]


def test_compaction_jobs_report(lake):
    for snapshot_id in range(2):
        ingest(lake, [hour_record(10, snapshot_id, user_id=f"u_{n}") for n in range(3)], snapshot_id)
        run_silver(lake)
    rows = {row.table_name: row for row in maintenance_jobs.compact_raw_and_clean(lake).collect()}
    assert rows[CLEAN_EVENTS].files_after == 1 < rows[CLEAN_EVENTS].files_before
    assert rows[CLEAN_EVENTS].bytes_after > 0 and len(rows) == 2


def test_compaction(lake):
    for snapshot_id in range(3):
        texts = [hour_record(hour, snapshot_id, user_id=f"u_{n}") for hour in (10, 11) for n in range(20)]
        ingest(lake, texts + ([hour_record(12)] if snapshot_id == 0 else []), snapshot_id)
        run_silver(lake)
    before = text_of(lake.read(CLEAN_EVENTS))
    untouched = {row.path for row in list_files(lake, "silver/bronze_clean").collect() if "473364" in row.path}
    assert compact(lake, CLEAN_EVENTS) and not compact(lake, CLEAN_EVENTS)
    assert text_of(lake.read(CLEAN_EVENTS)) == before
    totals, largest = compaction_report(lake, CLEAN_EVENTS)
    assert totals.first()["file_count"] == 3 and totals.first()["total_records"] == 121 and largest.count() == 3
    assert untouched < {row.path for row in list_files(lake, "silver/bronze_clean").collect()}
    # a small target size splits a partition again only as far as its bytes ask for
    plan = maintenance.compaction_plan(table_files(lake, CLEAN_EVENTS), target_bytes=1)
    assert plan.filter("rewrite").isEmpty() and plan.filter("target_file_count > 1").count() == 3


@pytest.mark.parametrize("folder", ["a b", "p%c"])
def test_compaction_below_odd_paths(spark, tmp_path, monkeypatch, folder):
    lake = Lake(spark, f"file://{tmp_path}/{folder}/lake")
    for snapshot in (1, 2, 3):
        ingest(lake, [record(user_id=f"u_{snapshot}_{n}") for n in range(3)], snapshot)
        run_silver(lake)
    before, files = text_of(lake.read(CLEAN_EVENTS)), table_files(lake, CLEAN_EVENTS).count()
    with monkeypatch.context() as broken:  # rows that find no file: nothing may go
        broken.setattr(maintenance_jobs, "broadcast_if_small", lambda counts: counts.where("false"))
        with pytest.raises(RuntimeError):
            compact(lake, CLEAN_EVENTS)
    assert text_of(lake.read(CLEAN_EVENTS)) == before and len(before) == 9
    assert compact(lake, CLEAN_EVENTS) and table_files(lake, CLEAN_EVENTS).count() < files
    assert text_of(lake.read(CLEAN_EVENTS)) == before


def test_compaction_of_bronze_and_of_partitions_without_a_time(lake):
    add_rules(lake)
    ingest(lake, [record(event_time=None), record()], 0)
    rows = bronze_of(lake.spark, [record(), record(price=5), record(event_time=None)]).repartition(3)
    lake.write_snapshot(rows.withColumn("snapshot_id", F.lit(1)), BRONZE)
    lake.commit(BRONZE, 1, "append")
    before = text_of(lake.read(BRONZE))
    assert compact(lake, BRONZE) and text_of(lake.read(BRONZE)) == before
    assert table_files(lake, BRONZE).count() == 2


def test_expiry_and_orphans(lake):
    spark = lake.spark
    for n in range(5):
        lake.replace(spark.createDataFrame([(f"v{n}",)], "user_id string").select(
            "user_id", *[F.lit(None).alias(name) for name in TABLES[USER_PROFILE].schema.names[1:]]), USER_PROFILE)
        ingest(lake, [hour_record(10, n)], n)
    lake.write_snapshot(bronze_of(spark, [hour_record(11)]).withColumn("snapshot_id", F.lit(99)), BRONZE)
    soon, later = F.current_timestamp(), F.current_timestamp() + F.expr("INTERVAL 30 DAYS")
    assert expire_snapshots(lake, soon).isEmpty()
    expired = expire_snapshots(lake, later)
    assert text_of(expired, "table_name", "snapshot_id") == [
        (name, str(n)) for name in sorted([BRONZE, USER_PROFILE]) for n in (0, 1)
    ]
    assert expire_snapshots(lake, later).isEmpty()
    assert live_snapshots(lake).count() == 6 and lake.read(SNAPSHOTS).count() == 14
    # expired appends stay part of the table; replaced versions and failed writes can go
    assert unreferenced_files(lake, BRONZE, soon).isEmpty()
    failed = unreferenced_files(lake, BRONZE, later)
    assert failed.count() >= 1 and failed.filter("path not like '%snapshot_id=99/%'").isEmpty()
    old = unreferenced_files(lake, USER_PROFILE, later)
    assert {row.path.split("snapshot_id=")[1][0] for row in old.collect()} == {"0", "1"}
    assert delete_files(lake, failed.unionByName(old)) >= 3
    assert text_of(lake.read(USER_PROFILE), "user_id") == [("v4",)]
    assert read_incremental(lake.read(BRONZE), None, 200).count() == 5
    assert stale_staging(lake, soon).isEmpty() and not stale_staging(lake, later).isEmpty()
    with pytest.raises(ValueError):
        unreferenced_files(lake, CLEAN_EVENTS)


def test_unpartitioned_tables_cannot_be_overwritten_in_part(lake):
    with pytest.raises(ValueError):
        lake.overwrite_partitions(lake.read(STATE), STATE)


def test_stream_equals_batch(lake):
    texts = [hour_record(10, n, user_id=f"u_{n}") for n in range(30)] + ["oops"]
    topic_of(lake.spark, texts).repartition(3).write.parquet(f"{lake.root}/landing")

    def drain():
        source = file_source(lake.spark, f"{lake.root}/landing")
        start_bronze(source, lake, f"{lake.root}/checkpoint", {"availableNow": True}).awaitTermination()

    drain()
    bronze = bronze_of(lake.spark, texts)
    assert text_of(lake.read(BRONZE), *bronze.columns) == text_of(bronze)
    assert text_of(lake.read(SNAPSHOTS), "snapshot_id", "batch_id") == [("0", "0"), ("1", "1"), ("2", "2")]
    more = [hour_record(11, user_id="more")]
    topic_of(lake.spark, more).coalesce(1).write.mode("append").parquet(f"{lake.root}/landing")
    drain()
    assert lake.read(BRONZE).count() == 32 and lake.read(SNAPSHOTS).count() == 4


def test_redelivered_batches(lake):
    """A committed batch is skipped; one that failed before its commit overwrites what it left."""
    lake.spark.createDataFrame([('{"id":"q-1"}',)], "value string").coalesce(1).write.text(f"{lake.root}/ckpt/metadata")
    batch = bronze_of(lake.spark, [record(), record(user_id="u_2")])
    sink = BronzeSink(lake, f"{lake.root}/ckpt")
    sink(batch, 0)
    sink(batch, 0)
    lake.write_snapshot(batch.withColumn("snapshot_id", F.lit(1)), BRONZE)  # batch 1, lost before its commit
    BronzeSink(lake, f"{lake.root}/ckpt")(batch, 1)
    assert lake.read(BRONZE).groupBy("snapshot_id").count().count() == 2
    assert lake.read(BRONZE).count() == 4 and lake.current_snapshot(BRONZE) == 1


def test_a_new_checkpoint_continues_the_snapshots(lake):
    batch = bronze_of(lake.spark, [record()])
    for query_id in ("q-1", "q-2"):
        text = lake.spark.createDataFrame([(f'{{"id":"{query_id}"}}',)], "value string")
        text.coalesce(1).write.text(f"{lake.root}/{query_id}/metadata")
        BronzeSink(lake, f"{lake.root}/{query_id}")(batch, 0)
    assert lake.read(BRONZE).count() == 2 and lake.current_snapshot(BRONZE) == 1


def test_local_store_paths(spark):
    assert Lake(spark, "/x/y/").path(CLEAN_EVENTS) == "/x/y/silver/bronze_clean"
