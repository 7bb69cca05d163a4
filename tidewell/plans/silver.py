"""Hourly job: new bronze snapshots to clean and quarantined events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tidewell.operators.drift import key_metrics, keys_of_metrics, schema_change_requests, schema_drift, with_key_sets
from tidewell.operators.merge import rows_to_insert
from tidewell.operators.ranges import affected_hours
from tidewell.operators.silver import (
    distinct_contents,
    one_per_hash,
    quality_summary,
    quarantine,
    silver_project,
    split_valid,
    validate,
)
from tidewell.operators.snapshots import latest_state
from tidewell.plans.clean_insert import insert_clean
from tidewell.schemas import BAD_EVENTS, BRONZE, CHANGES, DRIFT, QUALITY, QUEUE, STATE
from tidewell.sources.tables import Lake, read_committed, read_incremental, state_row

SILVER = "bronze_to_silver_events"
GOLD = "silver_to_gold_events"


def run_silver(lake: Lake) -> bool:
    """Process what bronze gained since the last run; False when there is nothing new."""
    spark = lake.spark
    current = lake.current_snapshot(BRONZE)
    if current is None:
        return False
    state = latest_state(lake.read(STATE), SILVER).first()
    last = state["last_snapshot_id"] if state else None
    if last == current:
        return False
    twice = read_incremental(lake.commits(BRONZE), last, current).groupBy("snapshot_id").count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError("two bronze commits share a snapshot id; a batch of one of them would be missed")
    load_id = -1 if last is None else last
    seen = Observation()
    batch = _batch(lake, read_committed(lake, BRONZE, last, current), seen)
    if not batch.isEmpty():  # of an empty batch nothing was observed
        _record_drift(lake, keys_of_metrics(seen.get), load_id)
        _load(lake, batch, current, load_id)
    lake.append(state_row(spark, SILVER, current), STATE)
    return True


def _batch(lake: Lake, bronze: DataFrame, seen: Observation) -> DataFrame:
    """The distinct validated events, staged, while ``seen`` takes the JSON keys: the records are read and parsed once.

    All that follows reads the staged events. They differ by content; contents that share a hash (only texts with the
    separator's bar can) are rare, so they are looked for in what was staged and only then grouped again.
    """
    records = with_key_sets(bronze.select("kafka_timestamp", "raw_value")).observe(seen, *key_metrics())
    found = validate(distinct_contents(silver_project(records))).withColumn("is_valid", F.size("error_reasons") == 0)
    batch = lake.stage(found, "silver", "is_valid")
    barred = batch.filter("_barred")
    if not barred.isEmpty():
        settled = batch.filter("not _barred").unionByName(one_per_hash(barred))
        batch = lake.stage(settled, "silver", "is_valid")
    return batch.withColumnRenamed("_copies", "copies").drop("_barred")


def _record_drift(lake: Lake, names: list[str], load_id: int) -> None:
    now = F.current_timestamp()
    keys = lake.spark.createDataFrame([(name,) for name in names], "column_name string")
    drift = schema_drift(keys, SILVER)
    if drift.isEmpty():
        return
    lake.write_load(drift.withColumn("checked_at", now), DRIFT, load_id)
    requests = schema_change_requests(keys, SILVER).withColumns(
        {
            "detected_at": now,
            "approved_at": F.lit(None).cast("timestamp"),
            "applied_at": F.lit(None).cast("timestamp"),
        }
    )
    identity = ["pipeline_name", "column_name", "change_type"]
    lake.write_load(rows_to_insert(lake.outside_load(CHANGES, load_id), requests, identity), CHANGES, load_id)


def _load(lake: Lake, batch: DataFrame, current: int, load_id: int) -> None:
    """Add the batch to the tables. A repeated attempt inserts no clean row twice and replaces what else the first one wrote."""
    now = F.current_timestamp()
    valid = split_valid(batch.filter("is_valid"))
    insert_clean(lake, valid, valid)
    lake.write_load(quarantine(batch.filter("not is_valid")), BAD_EVENTS, load_id)
    lake.write_load(quality_summary(batch, SILVER, current).withColumn("created_at", now), QUALITY, load_id)
    lake.write_load(affected_hours(valid, GOLD).withColumn("updated_at", now), QUEUE, load_id)
