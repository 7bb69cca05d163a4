"""The work queue of event hours, and reading only what it asks for."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.events import hour_index, hour_start

# One row is a bigint and two timestamps, so this many stay below about 16 MB.
BROADCAST_ROWS = 200_000
ISLANDS = 64  # intervals in a static condition
CELLS = 4096  # stretches of hours that the driver sees the ends of


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast only what is counted to be small; otherwise the join shuffles and AQE splits hot keys."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def affected_hours(events: DataFrame, pipeline: str) -> DataFrame:
    """Each hour the events fall in, as an open queue entry. Events without a time queue nothing."""
    hours = events.select(hour_index("event_time").alias("hour")).filter(F.col("hour").isNotNull()).distinct()
    return hours.select(
        F.lit(pipeline).alias("pipeline_name"),
        hour_start("hour").alias("start_time"),
        hour_start(F.col("hour") + 1).alias("end_time"),
        F.lit(False).alias("processed"),
    )


def pending_ranges(queue: DataFrame, pipeline: str) -> DataFrame:
    """Distinct open ranges of one pipeline, in time order."""
    rows = queue.filter((F.col("pipeline_name") == pipeline) & ~F.col("processed"))
    return rows.select("start_time", "end_time").distinct().orderBy("start_time", "end_time")


def mark_processed(queue: DataFrame, done: DataFrame) -> DataFrame:
    """The queue with every entry closed that was queued no later than a run that did its range.

    ``done`` has pipeline_name, start_time, end_time, run_start and done_at. Entries
    queued after the run began stay open, so that run's missing rows are picked up.
    """
    keys = ["pipeline_name", "start_time", "end_time"]
    last = done.groupBy(*keys).agg(F.max("run_start").alias("run_start"), F.max("done_at").alias("done_at"))
    closed = F.col("updated_at") <= F.col("run_start")
    newly = closed & ~F.col("processed")
    return queue.join(last, keys, "left").select(
        *keys,
        F.coalesce(F.col("processed") | closed, F.col("processed")).alias("processed"),
        F.when(newly, F.col("done_at")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def time_range(events: DataFrame, start: Column, end: Column) -> DataFrame:
    """start <= event_time < end; a NULL time is in no range. Bounds the hour partition too where there is one."""
    at = F.col("event_time")
    rows = events.filter((at >= start) & (at < end))
    if "p_hour" in events.columns:
        rows = rows.filter((F.col("p_hour") >= hour_index(start)) & (F.col("p_hour") <= hour_index(end)))
    return rows


def hours_of(ranges: DataFrame) -> DataFrame:
    """The hours (``p_hour``) that each half-open range touches, beside its bounds."""
    last_hour = hour_index(F.col("end_time") - F.expr("INTERVAL 1 MICROSECOND"))
    return ranges.filter(F.col("start_time") < F.col("end_time")).select(
        F.explode(F.sequence(hour_index("start_time"), last_hour)).alias("p_hour"), "start_time", "end_time"
    )


def islands(hours: DataFrame, most: int = ISLANDS) -> list[tuple[int, int]]:
    """At most ``most`` intervals that hold all hours, those with the widest gaps between them.

    The span is cut into ``CELLS`` equal cells; a cell gives its first and last hour, so the driver sees that many rows
    at most, however many hours there are. Cells without a gap between them join, then the narrowest gaps close.
    """
    hour = F.col("p_hour")
    hours = hours.filter(hour.isNotNull())
    low, high = hours.agg(F.min(hour), F.max(hour)).first()
    if low is None:
        return []
    width = (high - low) // CELLS + 1
    cells = hours.groupBy(F.expr(f"(p_hour - {low}) div {width}").alias("cell")).agg(F.min(hour).alias("low"), F.max(hour).alias("high"))
    found = sorted((row.low, row.high) for row in cells.collect())
    gaps = sorted(((after[0] - before[1], place) for place, (before, after) in enumerate(zip(found, found[1:]))), reverse=True)
    cuts = sorted(place for gap, place in gaps[: most - 1] if gap > 1)
    firsts, lasts = [0, *[place + 1 for place in cuts]], [*cuts, len(found) - 1]
    return [(found[first][0], found[last][1]) for first, last in zip(firsts, lasts)]


def within(bounds: list[tuple[int, int]]) -> Column:
    """The hour lies in one of the intervals: a condition on the partition column alone, so it prunes when the plan is made."""
    if not bounds:
        return F.lit(False)
    hour = F.col("p_hour")
    whole = hour.between(bounds[0][0], bounds[-1][1])
    return whole if len(bounds) == 1 else whole & reduce(or_, [hour.between(low, high) for low, high in bounds])


def in_ranges(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Events in any of the half-open ranges, all ranges in one pass.

    Ranges are cut into the hours they touch, so the join has an equality on the hour and keeps the exact bounds as a
    further condition. Stored events are first bounded by few intervals of hours, which prune directories however many
    ranges there are; where the ranges are few they are also broadcast and prune at run time.
    """
    hours = hours_of(ranges).withColumnRenamed("p_hour", "r_hour")
    if "p_hour" in events.columns:
        rows = events.filter(within(islands(hours.select(F.col("r_hour").alias("p_hour")))))
    else:
        rows = events.withColumn("p_hour", hour_index("event_time"))
    test = (
        (F.col("p_hour") == F.col("r_hour"))
        & (F.col("event_time") >= F.col("start_time"))
        & (F.col("event_time") < F.col("end_time"))
    )
    return rows.join(broadcast_if_small(hours), test, "left_semi").select(*events.columns)


def in_hours(table: DataFrame, hours: DataFrame) -> DataFrame:
    """Rows of a ``p_hour``-partitioned table in the given hours (a ``p_hour`` column, NULL included).

    Few intervals of hours prune directories when the plan is made, the broadcast when it runs.
    """
    has_null, rows = hours.agg(F.max(F.col("p_hour").isNull()), F.count(F.lit(1))).first()
    bounded = within(islands(hours))
    wanted = hours.filter(F.col("p_hour").isNotNull()).distinct()
    small = F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted
    found = table.filter(bounded).join(small, "p_hour", "left_semi").select(*table.columns)
    if has_null:
        found = found.unionByName(table.filter(F.col("p_hour").isNull()))
    return found
