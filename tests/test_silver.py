from __future__ import annotations

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import bronze_of, record, text_of
from tidewell.functions.events import hour_index, hour_start, wrapping_abs
from tidewell.operators import drift, silver

CASES = [
    ("oops", "event_time_is_null,price_is_null,event_type_is_null"),
    ("[1]", "event_time_is_null,price_is_null,event_type_is_null"),
    (record(event_time="garbage"), "event_time_is_null"),
    (record(price="12"), "price_is_null"),
    (record(price=1.5), "price_is_null"),
    (record(price=0), ""),
    (record(price=-1), "price_is_negative"),
    (record(event_type=None), "event_type_is_null"),
    (record(event_type="INVALID_EVENT", price=-100, event_time=None), "event_time_is_null,price_is_negative,invalid_event_type"),
    (record(price=3_000_000_000), ""),
    (record(user_id=..., product_id=..., category=..., device=...), ""),
]


def test_validation_rules(spark):
    batch = silver.silver_batch(bronze_of(spark, [text for text, _ in CASES]))
    # the two unparsable records are one event by content
    expected = sorted({reasons for text, reasons in CASES if text != "[1]"} - {""})
    found = batch.filter(F.size("error_reasons") > 0).select(F.array_join("error_reasons", ",").alias("r"))
    assert sorted({row.r for row in found.collect()}) == expected
    assert silver.split_valid(batch).count() == sum(not reasons for _, reasons in CASES)


@pytest.mark.parametrize("text,reasons", CASES)
def test_each_case(spark, text, reasons):
    row = silver.silver_batch(bronze_of(spark, [text])).select(F.array_join("error_reasons", ",")).first()
    assert row[0] == reasons


def test_bronze_price_is_32_bit(spark):
    bronze = bronze_of(spark, [record(price=3_000_000_000)])
    assert bronze.first()["price"] is None
    assert silver.silver_project(bronze).first()["price"] == 3_000_000_000


def test_hash_of_known_text(spark):
    bronze = bronze_of(spark, [record(), record(category=None, event_time=None, price=None)])
    found = {row.event_hash for row in silver.with_event_hash(silver.silver_project(bronze)).collect()}
    texts = ("u_1||view||p_1||book||100||2024-01-01 10:00:00||ios", "u_1||view||p_1||__NULL__||__NULL__||__NULL__||ios")
    assert found == {hashlib.sha256(text.encode()).hexdigest() for text in texts}


def test_dedup_keeps_earliest_and_counts_copies(spark):
    copies = [(record(), f"2024-01-01 10:00:{second:02d}") for second in (30, 10, 20)]
    batch = silver.silver_batch(bronze_of(spark, [*copies, record(user_id="u_2")]))
    assert text_of(batch, "user_id", "kafka_timestamp", "copies") == [
        ("u_1", "2024-01-01 10:00:10", "3"),
        ("u_2", "2024-01-01 10:00:30", "1"),
    ]


def test_dedup_by_hash_even_when_fields_differ(spark):
    """A NULL and the text that stands for it hash alike, so they are one event; the survivor is fixed."""
    texts = [(record(device=None), "2024-01-01 10:00:02"), (record(device="__NULL__"), "2024-01-01 10:00:01")]
    for order in (texts, texts[::-1]):
        rows = silver.silver_batch(bronze_of(spark, order)).collect()
        assert [row.device for row in rows] == ["__NULL__"]


def test_hot_copies_are_combined_before_the_shuffle(spark):
    bronze = bronze_of(spark, [record()]).crossJoin(spark.range(20000, numPartitions=4))
    deduped = silver.dedup_events(silver.with_event_hash(silver.silver_project(bronze)), copies="copies")
    assert [row.copies for row in deduped.collect()] == [20000]
    assert "partial_min" in deduped._jdf.queryExecution().toString()


def test_quarantine_columns(spark):
    row = silver.quarantine(silver.silver_batch(bronze_of(spark, [record(price=-1)]))).first()
    assert row.is_replayed is False and row.replayed_at is None and row.replay_batch_id is None
    assert row.created_at == row.quarantine_at and row.error_reasons == ["price_is_negative"]


def test_summary_of_an_empty_batch(spark):
    batch = silver.silver_batch(bronze_of(spark, [record()]).limit(0))
    row = silver.quality_summary(batch, "p", 1).first()
    assert (row.total_count, row.valid_count, row.bad_count, row.duplicate_removed_count) == (0, 0, 0, 0)


EVENTS = st.fixed_dictionaries(
    {
        "user_id": st.sampled_from(["u_1", "u_2", None]),
        "event_type": st.sampled_from(["view", "purchase", "INVALID_EVENT", None]),
        "price": st.sampled_from([None, -5, 0, 7]),
        "event_time": st.sampled_from([None, "2024-01-01T10:00:00Z", "bad"]),
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(EVENTS, min_size=1, max_size=30))
def test_counts_add_up(spark, events):
    batch = silver.silver_batch(bronze_of(spark, [record(**event) for event in events]))
    row = silver.quality_summary(batch, "p", 1).first()
    assert row.total_count == len(events)
    assert row.total_count == row.valid_count + row.bad_count + row.duplicate_removed_count
    names = ("user_id", "event_type", "price", "event_time")
    distinct = {tuple(None if event[name] == "bad" else event[name] for name in names) for event in events}
    assert row.valid_count + row.bad_count == len(distinct)


def test_drift_lists_are_sorted_and_only_written_for_new_keys(spark):
    keys = drift.observed_keys(bronze_of(spark, [record(zeta=1), record(alpha={"x": 1}, device=...), "oops"]))
    row = drift.schema_drift(keys, "p").first()
    assert row.new_columns == ["alpha", "zeta"] and row.missing_columns == []
    assert row.observed_columns == sorted(row.observed_columns) and len(row.observed_columns) == 9
    missing_only = drift.observed_keys(bronze_of(spark, [record(device=...)]))
    assert drift.schema_drift(missing_only, "p").isEmpty()
    assert drift.schema_change_requests(missing_only, "p").isEmpty()
    assert text_of(drift.schema_change_requests(keys, "p"), "column_name", "status") == [
        ("alpha", "pending"),
        ("zeta", "pending"),
    ]


def test_hours_before_and_after_the_epoch(spark):
    times = ["1969-12-31 23:30:00", "1970-01-01 00:59:59", "2024-01-01 10:00:00", "+100000-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("t"))
    rows = df.select(hour_index("t").alias("h"), (hour_start(hour_index("t")) == F.date_trunc("hour", "t")).alias("same"))
    found = rows.collect()
    assert [row.h for row in found[:3]] == [-1, 0, 473362] and all(row.same for row in found)
    assert found[3].h > 2**29


def test_abs_of_the_smallest_bigint(spark):
    df = spark.createDataFrame([(-(2**63),), (-5,), (5,), (None,)], "n bigint")
    assert [row[0] for row in df.select(wrapping_abs(F.col("n"))).collect()] == [-(2**63), 5, 5, None]
