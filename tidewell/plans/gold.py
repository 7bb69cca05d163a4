"""Hourly job: rebuild the aggregate tables for the queued hours and the user profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.gold import event_measures, hour_totals, leveled, refreshed_tables, window_totals
from tidewell.operators.profile import profile_of_totals, summed_totals, total_changes
from tidewell.operators.ranges import hours_of, in_ranges, mark_processed, pending_ranges
from tidewell.plans.silver import GOLD
from tidewell.schemas import CLEAN_EVENTS, QUEUE, QUEUE_DONE, TABLES, USER_HOURS, USER_PROFILE, USER_TOTALS
from tidewell.sources.tables import Lake, read_hours


def queue_state(lake: Lake) -> DataFrame:
    """The queue as users see it: entries and whether they are processed."""
    return mark_processed(lake.read(QUEUE), lake.read(QUEUE_DONE))


def run_start(lake: Lake) -> int:
    return lake.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]


def close_ranges(lake: Lake, ranges: DataFrame, pipeline: str, started: int) -> None:
    """Record that a run begun at ``started`` did these ranges. Only appends, so new entries cannot be lost."""
    done = ranges.select(
        F.lit(pipeline).alias("pipeline_name"),
        "start_time",
        "end_time",
        F.timestamp_micros(F.lit(started)).alias("run_start"),
        F.current_timestamp().alias("done_at"),
    )
    lake.append(done, QUEUE_DONE)


def run_gold(lake: Lake) -> bool:
    """Refresh all queued hours in one pass; False when none is queued.

    The clean rows of those hours (and those without a time) are read once and added up at all levels by one grouping;
    its staged sums give the seven tables by projection. The profile takes only differences: what the hours hold now
    less what the log of hourly changes holds of them is added to the running totals, so no other hour is read.

    Changes, totals and profile are written under one new version and count once its commit is logged. A run that dies
    before it leaves files that no reader sees, and the next run finds the same hours queued and the same former state.
    """
    started = run_start(lake)
    ranges = lake.stage(pending_ranges(queue_state(lake), GOLD), "ranges")
    if ranges.isEmpty():
        return False
    hours = hours_of(ranges).select("p_hour").distinct()
    events = in_ranges(read_hours(lake, CLEAN_EVENTS, hours), ranges).unionByName(lake.read_parts(CLEAN_EVENTS, [None]))
    sums = lake.stage(leveled(event_measures(events)), "sums", "level")
    totals = lake.stage(window_totals(sums), "totals", "level")
    version = max(started, lake.next_snapshot(USER_PROFILE))
    changes = lake.stage(total_changes(hour_totals(sums), former_totals(lake, hours)), "changes")
    now = F.current_timestamp()
    results = {}
    for dataset, table in refreshed_tables(sums, totals).items():
        name = f"gold.{dataset}"
        results[name] = table.withColumn("updated_at", now) if "updated_at" in TABLES[name].schema.names else table
    lake.overwrite_many(results)
    numbered = F.lit(version).alias("snapshot_id")
    lake.add_version(changes.select("*", numbered), USER_HOURS)
    grown = current_totals(lake).unionByName(changes.drop("p_hour"))
    lake.write_snapshot(summed_totals(grown).select("*", numbered), USER_TOTALS)
    profile = profile_of_totals(lake.read_parts(USER_TOTALS, [version]))
    lake.write_snapshot(profile.withColumn("updated_at", now).select("*", numbered), USER_PROFILE)
    lake.commit(USER_PROFILE, version, "replace")
    close_ranges(lake, ranges, GOLD, started)
    return True


def current_totals(lake: Lake) -> DataFrame:
    """The running totals per user, category and device that belong to the current profile."""
    current = lake.current_snapshot(USER_PROFILE)
    return lake.read_parts(USER_TOTALS, [] if current is None else [current]).drop("snapshot_id")


def former_totals(lake: Lake, hours: DataFrame) -> DataFrame:
    """What committed runs added for some hours, and for the events without a time."""
    timeless = lake.spark.range(1).select(F.lit(None).cast("bigint").alias("p_hour"))
    stored = read_hours(lake, USER_HOURS, hours.unionByName(timeless))
    committed = lake.commits(USER_PROFILE).select("snapshot_id").distinct()
    return stored.join(committed, "snapshot_id", "left_semi").drop("snapshot_id")
