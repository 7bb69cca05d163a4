"""Snapshot log and pipeline state lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_snapshot(log: DataFrame) -> DataFrame:
    """The newest snapshot by commit time; no row when there is none."""
    newest = [F.desc("committed_at"), F.desc("snapshot_id")]
    return log.orderBy(*newest).limit(1).select("snapshot_id")


def latest_state(state: DataFrame, pipeline: str) -> DataFrame:
    """How far the named pipeline had read at its last run; no row before the first."""
    rows = state.filter(F.col("pipeline_name") == pipeline)
    return rows.orderBy(F.desc("updated_at"), F.desc("last_snapshot_id")).limit(1).select("last_snapshot_id")
