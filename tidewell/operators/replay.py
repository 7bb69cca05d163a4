"""Repair of quarantined events by rules, and their return to the clean layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.events import (
    EVENT_TIME_IS_NULL,
    INVALID_EVENT_TYPE,
    PRICE_IS_NEGATIVE,
    error_reasons,
    wrapping_abs,
)
from tidewell.operators.merge import merge_update
from tidewell.operators.silver import with_event_hash

REPAIRABLE = (INVALID_EVENT_TYPE, PRICE_IS_NEGATIVE, EVENT_TIME_IS_NULL)


def replay_candidates(bad: DataFrame) -> DataFrame:
    return bad.filter(~F.col("is_replayed") & (F.size("error_reasons") > 0))


def error_reason_counts(bad: DataFrame) -> DataFrame:
    reasons = bad.select(F.explode("error_reasons").alias("error_reason"))
    return reasons.groupBy("error_reason").agg(F.count(F.lit(1)).alias("count"))


def active_rules(rules: DataFrame) -> DataFrame:
    return rules.filter(F.col("enabled") & F.col("auto_replay"))


def rule_actions(rules: DataFrame) -> dict[str, str | None]:
    """The action of each repairable reason that has an active rule: three entries at most."""
    known = active_rules(rules).filter(F.col("error_reason").isin(*REPAIRABLE))
    rows = known.groupBy("error_reason").agg(F.max("action_value").alias("action_value")).collect()
    return {row["error_reason"]: row["action_value"] for row in rows}


def repair_events(candidates: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates with their values repaired and a new ``event_hash``.

    An invalid type takes the rule's action value, a negative price its absolute
    value, a missing time the column the action value names (an unknown name
    fails). The former hash stays as ``original_event_hash``; ``unresolved`` are
    the rules the repaired row still breaks.
    """
    actions = rule_actions(rules)

    def repaired(reason: str, name: str, value) -> Column:
        if reason not in actions:
            return F.col(name)
        has_reason = F.array_contains("error_reasons", reason)
        return F.when(has_reason, value(actions[reason])).otherwise(F.col(name))

    values = {
        "event_type": repaired(INVALID_EVENT_TYPE, "event_type", lambda action: F.lit(action).cast("string")),
        "price": repaired(PRICE_IS_NEGATIVE, "price", lambda _: wrapping_abs(F.col("price"))),
        "event_time": repaired(EVENT_TIME_IS_NULL, "event_time", F.col),
    }
    fixed = candidates.withColumnRenamed("event_hash", "original_event_hash").withColumns(values)
    return with_event_hash(fixed).withColumn("unresolved", error_reasons())


def replayed_rows(repaired: DataFrame, strict: bool = False) -> DataFrame:
    """What goes back to the clean layer: every repaired row, or in strict mode those that break no rule."""
    return repaired.filter(F.size("unresolved") == 0) if strict else repaired


def mark_replayed(bad: DataFrame, hashes: DataFrame, batch_id: str, now: Column | None = None) -> DataFrame:
    """Quarantine rows with the replayed ones flagged; ``hashes`` has the quarantined ``event_hash``."""
    sets = {
        "is_replayed": F.lit(True),
        "replayed_at": F.current_timestamp() if now is None else now,
        "replay_batch_id": F.lit(batch_id),
    }
    return merge_update(bad, hashes, "event_hash", sets)


def replay_summary(repaired: DataFrame, batch_id: str, strict: bool = False) -> DataFrame:
    """Per error reason, how many candidates there were and how many went back."""
    went_back = (F.size("unresolved") == 0) if strict else F.lit(True)
    rows = repaired.select(F.explode("error_reasons").alias("source_error_reason"), went_back.alias("went_back"))
    return rows.groupBy("source_error_reason").agg(
        F.count(F.lit(1)).alias("candidate_count"),
        F.count_if("went_back").alias("repaired_count"),
        F.count_if(~F.col("went_back")).alias("skipped_count"),
    ).select(
        F.lit(batch_id).alias("replay_batch_id"),
        "source_error_reason",
        "candidate_count",
        "repaired_count",
        "skipped_count",
    )
