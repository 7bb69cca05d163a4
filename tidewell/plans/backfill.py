"""Backfill job: queued hours of datasets laid out by dt and hour into tables with those partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewell.functions.events import hour_index, hour_start
from tidewell.operators.ranges import broadcast_if_small, pending_ranges
from tidewell.plans.gold import close_ranges, queue_state, run_start
from tidewell.schemas import BACKFILL_DATASETS
from tidewell.sources.tables import Lake, read_gold_partitions

BACKFILL = "gold_backfill_events"


def range_hours(ranges: DataFrame) -> DataFrame:
    """Every hour each half-open range touches, as dt and two-digit hour beside the range."""
    last = hour_index(F.col("end_time") - F.expr("INTERVAL 1 MICROSECOND"))
    hours = ranges.filter(F.col("start_time") < F.col("end_time")).withColumn(
        "at", F.explode(F.sequence(hour_index("start_time"), last))
    )
    return hours.select(
        "start_time",
        "end_time",
        F.date_format(hour_start("at"), "yyyy-MM-dd").alias("dt"),
        F.date_format(hour_start("at"), "HH").alias("hour"),
    )


def run_backfill(lake: Lake, source_root: str, pipeline: str = BACKFILL) -> bool:
    """Copy all hours of the queued ranges of each dataset at once; False when none is queued.

    Ranges of which every hour was found are closed. An hour that no dataset has leaves its
    ranges open and raises after the others were copied.
    """
    started = run_start(lake)
    ranges = lake.stage(pending_ranges(queue_state(lake), pipeline), "ranges")
    if ranges.isEmpty():
        return False
    hours = lake.stage(range_hours(ranges), "hours")
    wanted = broadcast_if_small(hours.select("dt", "hour").distinct())
    sources, there = {}, []
    for dataset in BACKFILL_DATASETS:
        name = f"gold_backfill.{dataset}"
        source = read_gold_partitions(lake.spark, source_root, dataset, name).join(wanted, ["dt", "hour"], "left_semi")
        sources[name] = source
        there.append(source.select("dt", "hour").distinct())
    found = reduce(DataFrame.union, there).distinct()
    absent = lake.stage(hours.join(found, ["dt", "hour"], "left_anti"), "absent")
    lake.overwrite_many(sources)
    keys = ["start_time", "end_time"]
    close_ranges(lake, ranges.join(absent.select(*keys).distinct(), keys, "left_anti"), pipeline, started)
    first = absent.orderBy("dt", "hour").first()
    if first:
        raise ValueError(f"no source for {absent.count()} queued hours, first dt={first['dt']} hour={first['hour']}")
    return True
