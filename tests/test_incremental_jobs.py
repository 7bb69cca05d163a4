"""What a run reads and how often, and what is left when one dies half way."""

from __future__ import annotations

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from checks import fixture
from checks.queries import QUERIES
from conftest import SF, bronze_of, ingest, record, text_of
from tidewell.functions.events import PAYLOAD_FIELDS
from tidewell.operators import drift, gold, merge, profile, ranges, silver
from tidewell.plans import gold as gold_job
from tidewell.plans.gold import queue_state, run_gold
from tidewell.plans.replay import open_quarantine, run_replay
from tidewell.plans.silver import GOLD, run_silver
from tidewell.schemas import BAD_EVENTS, BRONZE, CHANGES, CLEAN_EVENTS, DRIFT, QUALITY, QUEUE, REPLAY_MARKS, RULES, STATE, TABLES, USER_HOURS, USER_PROFILE, USER_TOTALS
from tidewell.session import settings
from tidewell.sources import tables
from tidewell.sources.tables import Lake

RULE_ROWS = [("invalid_event_type", "view", True, True), ("price_is_negative", "abs", True, True)]
STAMPS = {"created_at", "quarantine_at", "updated_at", "checked_at", "detected_at"}


def hour_record(hour, minute=0, **changes):
    return record(event_time=f"2024-01-01T{hour:02d}:{minute:02d}:00Z", **changes)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def local(lake, name):
    return lake.path(name).removeprefix("file://")


def spoil(directory):
    """A file that fails any scan which lists it and opens it."""
    with open(os.path.join(directory, "part-spoilt.parquet"), "wb") as file:
        file.write(b"this is no parquet")


def contents(lake, *names):
    return {name: text_of(lake.read(name), *[c for c in lake.read(name).columns if c not in STAMPS | {"p_hour"}]) for name in names}


def rebuilt(lake):
    return profile.user_profile(gold.event_measures(lake.read(CLEAN_EVENTS)))


# --- profile by differences ----------------------------------------------------------------------


def test_profile_by_changes_equals_a_rebuild(lake):
    lake.append(lake.spark.createDataFrame(RULE_ROWS, TABLES[RULES].schema), RULES)
    kinds, places = ("view", "click", "purchase", "add_to_cart", "OTHER"), (None, "web", "ios")
    for batch in range(3):  # the later batches bring late events of the first hours too
        texts = [
            hour_record(
                8 + (n * (batch + 1)) % 5, n % 60, user_id=f"u_{n % 6}" if n % 11 else None, event_type=kinds[n % 5], price=n - 3,
                category=f"c_{(n + batch) % 3}" if n % 4 else None, device=places[n % 3], product_id=f"p_{batch}",
            )
            for n in range(40)
        ]
        ingest(lake, [*texts, record(event_time=None, user_id="timeless", product_id=f"p_{batch}")], batch)
        run_silver(lake)
        assert run_gold(lake)
        expected = rebuilt(lake)
        assert text_of(lake.read(USER_PROFILE), *expected.columns) == text_of(expected)
    run_replay(lake, "r")  # types and prices are repaired, the timeless go back as they are
    assert run_gold(lake) and not run_gold(lake)
    expected = rebuilt(lake)
    assert text_of(lake.read(USER_PROFILE), *expected.columns) == text_of(expected)
    totals = lake.read_parts(USER_TOTALS, [lake.current_snapshot(USER_PROFILE)])
    assert totals.agg(F.sum("n")).first()[0] == lake.read(CLEAN_EVENTS).count()


def test_a_refresh_opens_no_other_hour(lake):
    ingest(lake, [hour_record(hour, user_id=f"u_{hour}") for hour in (9, 10, 11)], 0)
    run_silver(lake)
    run_gold(lake)
    for name in (CLEAN_EVENTS, USER_HOURS):
        spoil(f"{local(lake, name)}/p_hour={473352 + 9}")
    ingest(lake, [hour_record(10, 5, user_id="late")], 1)
    assert run_silver(lake) and run_gold(lake)
    assert text_of(lake.read(USER_PROFILE), "user_id") == [("late",), ("u_10",), ("u_11",), ("u_9",)]


def test_a_refresh_that_dies_before_its_commit_is_done_again(lake, monkeypatch):
    ingest(lake, [hour_record(9), hour_record(10)], 0)
    run_silver(lake)
    run_gold(lake)
    ingest(lake, [hour_record(10, 7, user_id="late"), hour_record(11)], 1)
    run_silver(lake)
    commit = Lake.commit

    def dying(self, name, *rest):
        if name == USER_PROFILE:
            raise RuntimeError("lost")
        commit(self, name, *rest)

    with monkeypatch.context() as lost:
        lost.setattr(Lake, "commit", dying)
        with pytest.raises(RuntimeError):
            run_gold(lake)
    assert text_of(lake.read(USER_PROFILE), "user_id", "total_view") == [("u_1", "2")]  # as before
    assert run_gold(lake)
    expected = rebuilt(lake)
    assert text_of(lake.read(USER_PROFILE), *expected.columns) == text_of(expected)


# --- tables of a refresh from one grouping -------------------------------------------------------


def test_one_shuffle_carries_all_levels(spark):
    events = silver.split_valid(silver.silver_batch(bronze_of(spark, [record()])))
    text = plan(gold.leveled(gold.event_measures(spark.createDataFrame(events.collect(), events.schema))))
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text and "Window" not in text


def test_categories_named_unknown_and_missing_users(lake):
    texts = [
        hour_record(9, 1, category=None, user_id="a"), hour_record(9, 1, category="unknown", user_id="a"),
        hour_record(9, 2, category="unknown", user_id=None), hour_record(9, 2, device=None, user_id=None, price=2**62),
        hour_record(9, 3, price=2**62, user_id="b"), hour_record(9, 3, price=2**62, user_id="c"),
    ]
    ingest(lake, texts, 0)
    run_silver(lake)
    run_gold(lake)
    windows = gold.windowed(gold.event_measures(lake.read(CLEAN_EVENTS)))
    for dataset, table in gold.WINDOW_TABLES.items():
        expected = table(windows)
        assert text_of(lake.read(f"gold.{dataset}"), *expected.columns) == text_of(expected), dataset


# --- loads ---------------------------------------------------------------------------------------

ADDED = (CLEAN_EVENTS, BAD_EVENTS, QUALITY, QUEUE, DRIFT, CHANGES, STATE)


@pytest.mark.parametrize("last_write", [CHANGES, BAD_EVENTS, QUEUE])
def test_a_load_that_dies_and_runs_again_adds_nothing_twice(spark, tmp_path, monkeypatch, last_write):
    def filled(name):
        lake = Lake(spark, f"file://{tmp_path}/{name}")
        ingest(lake, [record(coupon="x"), record(price=-1), record(price=-1)], 0)
        run_silver(lake)
        ingest(lake, [record(coupon="y", campaign="z", user_id="u_2"), record(price=None, user_id="u_3"), record(price=-1)], 1)
        return lake

    lake, whole = filled("died"), filled("whole")
    write_load, append = Lake.write_load, Lake.append

    def dying(write):
        def run(self, df, name, *rest):
            write(self, df, name, *rest)
            if name == last_write:
                raise RuntimeError("lost")

        return run

    with monkeypatch.context() as lost:
        lost.setattr(Lake, "write_load", dying(write_load))
        lost.setattr(Lake, "append", dying(append))
        with pytest.raises(RuntimeError):
            run_silver(lake)
    assert run_silver(lake) and run_silver(whole)
    assert contents(lake, *ADDED) == contents(whole, *ADDED)


def test_a_repeated_load_may_cover_more_snapshots(lake, monkeypatch):
    """The load is named by where its range begins, so a later attempt over a longer range replaces the first."""
    ingest(lake, [record(price=-1)], 0)
    with monkeypatch.context() as lost:
        lost.setattr(Lake, "append", lambda self, df, name: (_ for _ in ()).throw(RuntimeError("lost")) if name == STATE else None)
        with pytest.raises(RuntimeError):
            run_silver(lake)
    ingest(lake, [record(price=-2)], 1)
    assert run_silver(lake)
    assert lake.read(BAD_EVENTS).count() == 2 and lake.read(QUALITY).count() == 1
    assert text_of(lake.read(QUALITY), "snapshot_id", "total_count") == [("1", "2")]


def test_the_records_of_a_batch_are_read_once(lake, monkeypatch):
    """Counted by an accumulator in the scan: drift, load and summary come from one pass over the records."""
    ingest(lake, [record(user_id=f"u_{n}", coupon="x" if n % 2 else "y") for n in range(50)] + ["oops"], 0)
    counter = lake.spark.sparkContext.accumulator(0)
    counted = F.udf(lambda offset: counter.add(1) or True, "boolean")
    read_parts = Lake.read_parts

    def reading(self, name, values):
        rows = read_parts(self, name, values)
        return rows.filter(counted("kafka_offset")) if name == BRONZE else rows

    monkeypatch.setattr(Lake, "read_parts", reading)
    assert run_silver(lake)
    assert counter.value == 51
    assert text_of(lake.read(CHANGES), "column_name") == [("coupon",)]
    assert text_of(lake.read(QUALITY), "total_count", "valid_count", "bad_count") == [("51", "50", "1")]


def test_incremental_reads_list_only_the_snapshots_of_the_log(lake):
    for snapshot_id in range(3):
        ingest(lake, [record(user_id=f"u_{snapshot_id}")], snapshot_id)
        if snapshot_id == 1:
            run_silver(lake)
    for snapshot_id in (0, 1):
        spoil(f"{local(lake, BRONZE)}/snapshot_id={snapshot_id}")
    os.makedirs(f"{local(lake, BRONZE)}/snapshot_id=none")  # no number: a listing of the whole table fails on it
    spoil(f"{local(lake, BRONZE)}/snapshot_id=none")
    assert run_silver(lake)
    assert text_of(lake.read(CLEAN_EVENTS), "user_id") == [("u_0",), ("u_1",), ("u_2",)]


def test_key_sets_of_any_order(spark):
    """Only unusual key sets are listed; the metrics read columns, not the texts once more per metric."""
    usual, turned = record(), json.dumps(dict(reversed(json.loads(record()).items())))
    texts = [usual, turned, record(coupon="x"), record(price=...), usual[:-1] + ', "price": 1}', "oops", "[1]", None]
    rows = drift.with_key_sets(spark.createDataFrame([(text,) for text in texts], "raw_value string"))
    metrics = rows.agg(*drift.key_metrics()).first().asDict()
    every = sorted(PAYLOAD_FIELDS)
    assert metrics["as_expected"] == 1
    wanted = [every, sorted([*every, "coupon"]), [name for name in every if name != "price"]]
    assert sorted(metrics["other_sets"]) == sorted(wanted)
    assert drift.keys_of_metrics(metrics) == sorted([*every, "coupon"])
    assert not any("json" in str(metric) for metric in drift.key_metrics())


def test_a_table_before_its_first_write_is_known_to_be_empty(lake):
    """The first load neither shuffles nor joins its batch with it."""
    rows = lake.stage(lake.spark.createDataFrame([("a",)], "event_hash string"), "rows")
    for absent in (lake.read(CLEAN_EVENTS), lake.read_parts(CLEAN_EVENTS, [1, 2])):
        found = merge.rows_to_insert(merge.stored_keys(absent, rows, "event_hash"), rows, ["event_hash"])
        assert "Join" not in plan(found) and "Exchange" not in plan(found)
        assert text_of(found) == [("a",)] and absent.schema == TABLES[CLEAN_EVENTS].full_schema


def test_quarantine_and_marks_of_one_hour_are_written_by_many_tasks(lake, monkeypatch):
    monkeypatch.setattr(tables, "SPLIT_TASKS", tables.SPLIT_TASKS | {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"})
    at = F.lit("2024-01-01 10:00:00").cast("timestamp")

    def rows(name):
        columns = [F.lit(None).cast(field.dataType).alias(field.name) for field in TABLES[name].schema if field.name != "event_hash"]
        made = lake.spark.range(0, 4000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("event_hash"), *columns)
        return made.withColumn(TABLES[name].time_column, at)

    lake.write_load(rows(BAD_EVENTS).withColumn("p_hour", F.lit(473362)), BAD_EVENTS, 1)
    lake.append(rows(REPLAY_MARKS), REPLAY_MARKS)
    for name in (BAD_EVENTS, REPLAY_MARKS):
        assert len(lake.read_plain(name).inputFiles()) > 2
        assert lake.read_plain(name).count() == 4000


def test_the_backfill_query_reads_the_topic_once(spark, monkeypatch):
    topic, calls = fixture.topic, []
    monkeypatch.setattr(fixture, "topic", lambda *arguments: calls.append(1) or topic(*arguments))
    assert QUERIES["gold_partition_backfill"](spark, SF).count() > 0
    assert len(calls) == 1


# --- replay --------------------------------------------------------------------------------------


def test_open_rows_are_found_without_the_marks_of_closed_hours(lake):
    def quarantined(day, user, at=0):
        rows = silver.silver_batch(bronze_of(lake.spark, [record(user_id=user, price=-1)])).drop("copies")
        stamp = F.lit(f"2024-02-{day:02d} 00:00:0{at}").cast("timestamp")
        lake.append(silver.quarantine(rows, stamp), BAD_EVENTS)

    for day, user in ((1, "a"), (2, "b")):
        quarantined(day, user)
    assert run_replay(lake, "first") and not run_replay(lake, "none")
    quarantined(2, "b", at=5)  # the same event again in an hour that was closed
    quarantined(3, "c")
    found = open_quarantine(lake)
    assert text_of(found, "user_id", "quarantine_at") == [("b", "2024-02-02 00:00:05"), ("c", "2024-02-03 00:00:00")]
    marks = [path for path in found.inputFiles() if "replay_marks" in path]
    assert marks and all("p_hour=474120" in path for path in marks)  # the second of February; the first is closed
    assert run_replay(lake, "second") and open_quarantine(lake).isEmpty()
    expected = [("a", "first"), ("b", "second"), ("b", "second"), ("c", "second")]  # a mark counts for all copies of a hash
    assert text_of(lake.read(BAD_EVENTS), "user_id", "replay_batch_id") == expected


# --- deduplication -------------------------------------------------------------------------------


def test_dedup_aggregates_by_hash(spark):
    events = silver.with_event_hash(silver.silver_project(bronze_of(spark, [record()])))
    for df in (silver.dedup_events(events, "copies"), silver.distinct_contents(events)):
        text = plan(df)
        assert "SortAggregate" not in text and "Window" not in text and "HashAggregate" in text


@pytest.mark.parametrize("use", ["summary", "windows"])
def test_branches_of_the_dedup_share_one_scan(spark, use):
    """Whatever is asked of the batch, its rows with and without bars come from one shuffle of one scan."""
    counter = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda offset: counter.add(1) or True, "boolean")
    batch = silver.silver_batch(bronze_of(spark, [record(user_id=f"u_{n}", event_time=None if n % 3 else ...) for n in range(30)] + [record()]).filter(counted("kafka_offset")))
    if use == "summary":
        assert silver.quality_summary(batch, "p", 1).first().total_count == 31
    else:
        windows = gold.windowed(gold.event_measures(silver.split_valid(batch).drop("copies")))
        assert gold.device_5min_summary(windows).count() == 1
    assert counter.value == 31


def test_contents_that_hash_alike_are_one_event(spark, lake):
    """Texts with the separator inside shift it; the earliest by topic time stays, with all copies counted."""
    pairs = [
        (record(user_id="a||b", event_type="view", product_id="p"), "2024-01-01 10:00:03"),
        (record(user_id="a", event_type="b||view", product_id="p"), "2024-01-01 10:00:02"),
        (record(user_id="a", event_type="b", product_id="view||p"), "2024-01-01 10:00:01"),
        (record(user_id="a|", event_type="b"), "2024-01-01 10:00:05"), (record(user_id="a", event_type="|b"), "2024-01-01 10:00:04"),
        (record(user_id="one|bar"), "2024-01-01 10:00:00"), (record(), "2024-01-01 10:00:00"), (record(), "2024-01-01 10:00:09"),
        (record(category=None, device="__NULL__"), "2024-01-01 10:00:02"), (record(category="__NULL__", device=None), "2024-01-01 10:00:01"),
    ]
    shifted = [(record(user_id="a||b", event_type="c"), "2024-01-01 10:00:03"), (record(user_id="a", event_type="b||c", product_id=...), "2024-01-01 10:00:02")]
    for texts in (pairs, pairs[::-1]):
        rows = silver.silver_batch(bronze_of(spark, texts)).collect()
        assert len({row.event_hash for row in rows}) == len(rows)
        found = {(row.user_id, row.event_type, row.product_id, row.category, row.device): row.copies for row in rows}
        assert found[("u_1", "view", "p_1", "book", "ios")] == 2 and found[("u_1", "view", "p_1", "__NULL__", None)] == 2
        assert found[("one|bar", "view", "p_1", "book", "ios")] == 1 and sum(found.values()) == len(pairs)
        assert ("a", "|b", "p_1", "book", "ios") in found and ("a|", "b", "p_1", "book", "ios") not in found
    ingest(lake, [text for text, _ in pairs + shifted], 0)
    run_silver(lake)
    direct = silver.silver_batch(bronze_of(spark, [text for text, _ in pairs + shifted]))
    assert sorted(row.event_hash for row in direct.collect()) == sorted(
        row.event_hash for name in (CLEAN_EVENTS, BAD_EVENTS) for row in lake.read(name).collect()
    )


# --- ranges --------------------------------------------------------------------------------------


def hours_df(spark, hours):
    return spark.createDataFrame([(hour,) for hour in hours], "p_hour bigint")


def test_islands_hold_every_hour_and_no_wide_gap(spark):
    hours = [0, 1, 2, 10, 11, 500, -40, 500_000, 500_001]
    assert ranges.islands(hours_df(spark, hours)) == [(-40, 11), (500, 500), (500_000, 500_001)]  # cells of 123 hours
    assert ranges.islands(hours_df(spark, hours), most=2) == [(-40, 500), (500_000, 500_001)]
    assert ranges.islands(hours_df(spark, [3, 4, 7])) == [(3, 4), (7, 7)]
    assert ranges.islands(hours_df(spark, [])) == [] and ranges.islands(hours_df(spark, [5]), most=1) == [(5, 5)]


def test_many_ranges_prune_directories_without_a_broadcast(lake):
    texts = [hour_record(hour, minute, user_id=f"u_{hour}_{minute}") for hour in (1, 2, 3, 12, 13, 22) for minute in (0, 30)]
    ingest(lake, texts, 0)
    run_silver(lake)
    clean = lake.read(CLEAN_EVENTS)
    sql = "SELECT timestamp_micros({0} + id * {1}) AS start_time, timestamp_micros({0} + (id + 1) * {1}) AS end_time FROM range({2})"
    start = 1704067200_000000 + 2 * 3600_000000  # from two o'clock on, a range per 20 milliseconds for 90 minutes
    wanted = lake.spark.sql(sql.format(start, 20_000, 270_000)).unionByName(lake.spark.sql(
        "SELECT timestamp'2024-01-01 22:00:00' AS start_time, timestamp'2024-01-01 22:10:00' AS end_time"))
    with settings(lake.spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):  # at 100 TB its size alone would forbid it
        found = ranges.in_ranges(clean, lake.stage(wanted, "ranges"))
        text = plan(found)
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "BroadcastHashJoin" not in text and re.search(r"473354", filters) and re.search(r"473374", filters)
    assert text_of(found, "user_id") == [("u_22_0",), ("u_2_0",), ("u_2_30",), ("u_3_0",)]
    few = ranges.in_ranges(clean, wanted.limit(3))
    assert "BroadcastHashJoin" in plan(few) and "dynamicpruning" in plan(few)
    assert queue_state(lake).count() == 6 and GOLD == gold_job.GOLD
