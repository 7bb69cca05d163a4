from __future__ import annotations

from pyspark.sql import functions as F

from conftest import text_of
from tidewell.operators import merge, ranges


def times(spark, rows, schema):
    """Columns named *_time, *_at or run_start as timestamps."""
    df = spark.createDataFrame(rows, schema)
    stamps = [name for name in df.columns if name.endswith(("_time", "_at", "_start"))]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in stamps})


def test_insert_where_absent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("b", 9), ("c", 3), (None, 4)], "k string, v int")
    assert text_of(merge.rows_to_insert(target, source, ["k"])) == [(None, "4"), ("c", "3")]
    # a NULL key matches nothing, also no NULL key
    again = merge.merge_insert(merge.merge_insert(target, source, ["k"]), source, ["k"])
    assert text_of(again) == [(None, "4"), (None, "4"), ("a", "1"), ("b", "2"), ("c", "3")]


def test_insert_on_several_keys(spark):
    schema = "a string, b string, v int"
    target = spark.createDataFrame([("x", "y", 1)], schema)
    source = spark.createDataFrame([("x", "y", 2), ("x", "z", 3), ("x", None, 4)], schema)
    assert text_of(merge.rows_to_insert(target, source, ["a", "b"])) == [("x", None, "4"), ("x", "z", "3")]


def test_update_matches_once_however_often_the_source_repeats(spark):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    source = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    updated = merge.merge_update(target, source, "k", {"v": F.lit(0)})
    assert text_of(updated) == [(None, "4"), ("a", "0"), ("a", "0"), ("b", "3")]
    assert updated.columns == target.columns


QUEUE = "pipeline_name string, start_time string, end_time string, processed boolean, updated_at string"
DONE = "pipeline_name string, start_time string, end_time string, run_start string, done_at string"
H10, H11, H12 = "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2024-01-01 12:00:00"


def test_entries_queued_during_a_run_stay_open(spark):
    queue = times(
        spark,
        [
            ("p", H10, H11, False, "2024-01-01 11:05:00"),
            ("p", H10, H11, False, "2024-01-01 11:30:00"),
            ("p", H11, H12, False, "2024-01-01 11:05:00"),
            ("other", H10, H11, False, "2024-01-01 11:05:00"),
        ],
        QUEUE,
    )
    done = times(spark, [("p", H10, H11, "2024-01-01 11:20:00", "2024-01-01 11:40:00")], DONE)
    state = ranges.mark_processed(queue, done)
    assert text_of(state, "pipeline_name", "start_time", "processed", "updated_at") == [
        ("other", H10, "false", "2024-01-01 11:05:00"),
        ("p", H10, "false", "2024-01-01 11:30:00"),
        ("p", H10, "true", "2024-01-01 11:40:00"),
        ("p", H11, "false", "2024-01-01 11:05:00"),
    ]
    assert [str(row.start_time) for row in ranges.pending_ranges(state, "p").collect()] == [H10, H11]


def test_affected_hours_skip_missing_times(spark):
    events = times(spark, [(H10,), ("2024-01-01 10:59:59.999999",), (H12,), (None,)], "event_time string")
    assert text_of(ranges.affected_hours(events, "p"), "start_time", "end_time", "processed") == [
        (H10, H11, "false"),
        (H12, "2024-01-01 13:00:00", "false"),
    ]


EVENTS = [("a", H10), ("b", "2024-01-01 10:59:59.999999"), ("c", H11), ("d", "2024-01-01 12:30:00"), ("e", None)]


def test_range_edges(spark):
    events = times(spark, EVENTS, "id string, event_time string")
    spans = times(spark, [(H10, H11)], "start_time string, end_time string")
    assert text_of(ranges.in_ranges(events, spans), "id") == [("a",), ("b",)]
    bounds = (F.lit(text).cast("timestamp") for text in (H10, H11))
    assert text_of(ranges.time_range(events, *bounds), "id") == [("a",), ("b",)]


def test_overlapping_long_and_empty_ranges(spark, monkeypatch):
    events = times(spark, EVENTS, "id string, event_time string")
    spans = times(
        spark,
        [(H10, "2024-01-01 12:15:00"), ("2024-01-01 10:30:00", H12), (H12, H12), (H12, H11)],
        "start_time string, end_time string",
    )
    for limit in (ranges.BROADCAST_ROWS, 0):
        monkeypatch.setattr(ranges.broadcast_if_small, "__defaults__", (limit,))
        assert text_of(ranges.in_ranges(events, spans), "id") == [("a",), ("b",), ("c",)]


def test_hours_of_a_table(spark, monkeypatch):
    table = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "p_hour bigint, id string")
    some = spark.createDataFrame([(1,), (3,), (3,), (None,)], "p_hour bigint")
    for limit in (ranges.BROADCAST_ROWS, 0):
        monkeypatch.setattr(ranges, "BROADCAST_ROWS", limit)
        assert text_of(ranges.in_hours(table, some), "id") == [("a",), ("c",), ("n",)]
        assert text_of(ranges.in_hours(table, some.filter("p_hour is not null")), "id") == [("a",), ("c",)]
        assert ranges.in_hours(table, some.limit(0)).isEmpty()
        assert text_of(ranges.in_hours(table, some.filter("p_hour is null")), "id") == [("n",)]
