"""Repair-and-replay job: quarantined events back to the clean layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.ranges import affected_hours, broadcast_if_small, in_hours
from tidewell.operators.replay import repair_events, replay_candidates, replay_summary, replayed_rows
from tidewell.operators.silver import SILVER_COLUMNS, dedup_events
from tidewell.plans.clean_insert import insert_clean
from tidewell.plans.gold import run_start
from tidewell.plans.silver import GOLD
from tidewell.schemas import BAD_EVENTS, QUEUE, REPLAY_MARKS, REPLAYS, RULES
from tidewell.sources.tables import Lake, read_hours


def run_replay(lake: Lake, batch_id: str, strict: bool = False) -> bool:
    """Repair and replay all open quarantined events; False when there is none.

    The repaired candidates are staged, so all later steps see the same rows even
    while new ones are quarantined. With ``strict`` rows that still break a rule
    stay in quarantine and count as skipped; by default they go back as they are.
    Replayed rows are marked by appending, so rows quarantined meanwhile are never rewritten.
    """
    now, started = F.current_timestamp(), run_start(lake)
    candidates = replay_candidates(open_quarantine(lake))
    repaired = lake.stage(repair_events(candidates, lake.read(RULES)), "replay")
    if repaired.isEmpty():
        return False
    rows = replayed_rows(repaired, strict)
    insert_clean(lake, dedup_events(rows.select(*SILVER_COLUMNS)), rows)
    lake.append(affected_hours(rows, GOLD).withColumn("updated_at", now), QUEUE)
    marks = rows.select(F.col("original_event_hash").alias("event_hash"), "quarantine_at").distinct()
    values = {"read_until": F.timestamp_micros(F.lit(started)), "replayed_at": now, "replay_batch_id": F.lit(batch_id)}
    lake.append(marks.withColumns(values), REPLAY_MARKS)
    lake.append(replay_summary(repaired, batch_id, strict).withColumn("created_at", now), REPLAYS)
    return True


def open_quarantine(lake: Lake) -> DataFrame:
    """Quarantined rows that no replay marked, from the hours that may hold one.

    An hour whose rows and whose marks agree in number and in the combined hash of their identities is closed: of its
    marks only these two figures are shuffled. The marks of the other hours are read by name, and broadcast if few.
    """
    identity = ["event_hash", "quarantine_at"]

    def figures(rows: DataFrame, suffix: str) -> DataFrame:
        together = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*identity))).alias(f"of_{suffix}")
        return rows.groupBy("p_hour").agg(together)

    rows = lake.read_plain(BAD_EVENTS)
    compared = figures(rows, "rows").join(figures(lake.read(REPLAY_MARKS), "marks"), "p_hour", "left")
    hours = lake.stage(compared.filter(~F.col("of_rows").eqNullSafe(F.col("of_marks"))).select("p_hour"), "hours")
    marks = read_hours(lake, REPLAY_MARKS, hours).select("p_hour", *identity)
    return in_hours(rows, hours).join(broadcast_if_small(marks), ["p_hour", *identity], "left_anti").select(*rows.columns)
