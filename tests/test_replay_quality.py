from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import bronze_of, record, text_of
from tidewell.functions.events import error_reasons, event_hash
from tidewell.operators import quality, replay, silver

RULES = "error_reason string, action_value string, enabled boolean, auto_replay boolean"
ALL = [
    ("invalid_event_type", "view", True, True),
    ("price_is_negative", "abs", True, True),
    ("event_time_is_null", "kafka_timestamp", True, True),
]
TEXTS = [
    record(user_id="type", event_type="INVALID_EVENT"),
    record(user_id="price", price=-7),
    record(user_id="time", event_time=None),
    record(user_id="all", event_type="x", price=-8, event_time="bad"),
    record(user_id="none", price=None),
    record(user_id="smallest", price=-(2**63)),
]


def repaired(spark, rules=ALL):
    bad = silver.quarantine(silver.silver_batch(bronze_of(spark, TEXTS)))
    return replay.repair_events(bad, spark.createDataFrame(rules, RULES))


def test_all_rules(spark):
    rows = repaired(spark)
    assert text_of(rows, "user_id", "event_type", "price", "event_time") == [
        ("all", "view", "8", "2024-01-01 10:00:30"),
        ("none", "view", None, "2024-01-01 10:00:00"),
        ("price", "view", "7", "2024-01-01 10:00:00"),
        ("smallest", "view", str(-(2**63)), "2024-01-01 10:00:00"),
        ("time", "view", "100", "2024-01-01 10:00:30"),
        ("type", "view", "100", "2024-01-01 10:00:00"),
    ]
    # every row hashes by its repaired content
    assert rows.filter(F.col("event_hash") != event_hash()).isEmpty()
    open_rows = rows.filter(F.size("unresolved") > 0)
    assert text_of(open_rows, "user_id") == [("none",), ("smallest",)]
    assert text_of(replay.replayed_rows(rows), "user_id") == text_of(rows, "user_id")
    assert replay.replayed_rows(rows, strict=True).count() == 4


@pytest.mark.parametrize("enabled,auto", [(False, True), (True, False), (None, True)])
def test_inactive_rules_change_nothing(spark, enabled, auto):
    rows = repaired(spark, [(reason, action, enabled, auto) for reason, action, _, _ in ALL])
    assert rows.filter(F.col("event_hash") != F.col("original_event_hash")).isEmpty()


def test_rule_with_other_values(spark):
    rows = repaired(spark, [("invalid_event_type", "click", True, True), ("unheard_of", "x", True, True)])
    assert text_of(rows.filter("user_id = 'type'"), "event_type") == [("click",)]
    missing = repaired(spark, [("invalid_event_type", None, True, True)])
    assert text_of(missing.filter("user_id = 'type'"), "event_type") == [(None,)]


def test_unknown_time_column_fails(spark):
    with pytest.raises(AnalysisException):
        repaired(spark, [("event_time_is_null", "no_such_column", True, True)]).collect()


def test_candidates_and_counts(spark):
    bad = silver.quarantine(silver.silver_batch(bronze_of(spark, TEXTS)))
    hashes = bad.filter("user_id in ('price', 'time')").select("event_hash")
    marked = replay.mark_replayed(bad, hashes.unionByName(hashes), "batch")
    assert marked.count() == bad.count()
    assert text_of(marked.filter("is_replayed"), "user_id", "replay_batch_id") == [("price", "batch"), ("time", "batch")]
    assert text_of(replay.replay_candidates(marked), "user_id") == [("all",), ("none",), ("smallest",), ("type",)]
    assert text_of(replay.error_reason_counts(bad)) == [
        ("event_time_is_null", "2"),
        ("invalid_event_type", "2"),
        ("price_is_negative", "3"),
        ("price_is_null", "1"),
    ]


def test_summary(spark):
    rows = repaired(spark)
    columns = ("source_error_reason", "candidate_count", "repaired_count", "skipped_count")
    assert text_of(replay.replay_summary(rows, "b"), *columns)[-1] == ("price_is_null", "1", "1", "0")
    strict = text_of(replay.replay_summary(rows, "b", strict=True), *columns)
    assert strict[-2:] == [("price_is_negative", "3", "2", "1"), ("price_is_null", "1", "0", "1")]


SUMMARY = (
    "pipeline_name string, snapshot_id bigint, total_count bigint, valid_count bigint, bad_count bigint, "
    "duplicate_removed_count bigint, created_at string"
)


def metrics(spark, *rows):
    return quality.data_quality_metrics(spark.createDataFrame(list(rows), SUMMARY))


def test_metrics_of_the_newest_summary(spark):
    row = metrics(spark, ("a", 1, 9, 9, 9, 9, "2024-01-01"), ("b", 7, 200, 180, 10, 10, "2024-01-02")).first()
    assert (row.pipeline_name, row.snapshot_id, row.bad_rate, row.duplicate_rate) == ("b", "7", 0.05, 0.05)
    empty = metrics(spark, ("b", 7, 0, 0, 0, 0, "2024-01-02")).first()
    assert (empty.bad_rate, empty.duplicate_rate) == (0.0, 0.0)


def test_alert_thresholds_are_strict(spark):
    def alerts(bad, duplicates):
        return quality.quality_alerts(metrics(spark, ("p", 1, 1000, 0, bad, duplicates, "2024-01-01"))).collect()

    assert not alerts(50, 100)
    assert len(alerts(51, 0)) == 1
    (alert,) = alerts(0, 101)
    assert "Bad Rate: 0.00%" in alert.message and "Duplicate Rate: 10.10%" in alert.message


@pytest.mark.parametrize("bad,total", [(3111, 12000), (1, 3), (12345, 100000), (1, 1), (205, 1600)])
def test_percent_rounds_like_plain_formatting(spark, bad, total):
    rows = metrics(spark, ("p", 1, total, 0, bad, 0, "2024-01-01"))
    assert f"Bad Rate: {bad / total:.2%}" in quality.quality_alerts(rows).first().message


def test_reasons_have_no_nulls(spark):
    df = spark.createDataFrame([(None, None, None)], "event_time timestamp, price bigint, event_type string")
    assert df.select(error_reasons()).first()[0] == ["event_time_is_null", "price_is_null", "event_type_is_null"]
