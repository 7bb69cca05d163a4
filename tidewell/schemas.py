"""Declared schemas and partition columns of every table.

``p_hour`` is the number of whole hours since the epoch (UTC) of the table's
time column: parquet has no hidden partitions, so the bucket is a real column.
Bronze is divided by snapshot only, which is how it is read: a second division
by event hour would turn every late record of every minute into a file of its
own. Row-group statistics still skip by time, as records arrive roughly in order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    columns: str
    partitions: tuple[str, ...] = ()
    time_column: str | None = None

    @property
    def names(self) -> tuple[str, ...]:
        """Names of the declared columns; needs no session."""
        return tuple(column.split()[0] for column in self.columns.split(", "))

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def full_schema(self) -> T.StructType:
        schema = self.schema
        for name in self.partitions:
            if name not in schema.names:
                kind = T.StringType() if name in ("dt", "hour") else T.LongType()
                schema = schema.add(name, kind)
        return schema


# Names the load that wrote a row, by where its snapshot range begins; readers never see it.
LOAD = "load_id"

EVENT = "user_id string, event_type string, product_id string, category string, price bigint, event_time timestamp"
CLEAN = f"{EVENT}, kafka_timestamp timestamp, device string, event_hash string"
SUMMARY = (
    "view_count bigint, click_count bigint, add_to_cart_count bigint, purchase_count bigint, "
    "ctr double, add_to_cart_rate double, purchase_conversion_rate double, "
    "revenue double, active_user_count bigint, updated_at timestamp"
)

USER_SUMS = (
    "user_id string, category string, device string, total_view bigint, total_click bigint, total_add_to_cart bigint, "
    "total_purchase bigint, total_revenue double, last_active_time timestamp, n bigint"
)

BRONZE = "bronze.kafka_events"
CLEAN_EVENTS = "silver.bronze_clean"
BAD_EVENTS = "silver.bad_events"
USER_PROFILE = "gold.user_profile"
USER_HOURS = "gold.user_hour_deltas"
USER_TOTALS = "gold.user_totals"
SNAPSHOTS = "meta.snapshots"
QUEUE = "meta.pipeline_partitions"
QUEUE_DONE = "meta.pipeline_partitions_done"
REPLAY_MARKS = "meta.replay_marks"
STATE = "meta.pipeline_state"
QUALITY = "meta.pipeline_quality_summary"
METRICS = "meta.data_quality_metrics"
DRIFT = "meta.schema_drift_summary"
CHANGES = "meta.schema_change_requests"
RULES = "meta.repair_rules"
REPLAYS = "meta.replay_quality_summary"

TABLES: dict[str, Table] = {
    BRONZE: Table(
        f"{EVENT}, kafka_timestamp timestamp, raw_value string, kafka_topic string, "
        "kafka_partition int, kafka_offset bigint",
        ("snapshot_id",),
    ),
    CLEAN_EVENTS: Table(CLEAN, ("p_hour",), "event_time"),
    BAD_EVENTS: Table(
        f"{EVENT}, device string, kafka_timestamp timestamp, event_hash string, created_at timestamp, "
        "quarantine_at timestamp, is_replayed boolean, replayed_at timestamp, replay_batch_id string, "
        "error_reasons array<string>",
        (LOAD, "p_hour"),
        "created_at",
    ),
    SNAPSHOTS: Table(
        "snapshot_id bigint, committed_at timestamp, operation string, "
        "source_id string, batch_id bigint, table_name string",
        ("table_name",),
    ),
    STATE: Table("pipeline_name string, last_snapshot_id bigint, updated_at timestamp"),
    QUALITY: Table(
        "pipeline_name string, snapshot_id bigint, total_count bigint, valid_count bigint, "
        "bad_count bigint, duplicate_removed_count bigint, created_at timestamp",
        (LOAD,),
    ),
    DRIFT: Table(
        "pipeline_name string, observed_columns array<string>, missing_columns array<string>, "
        "new_columns array<string>, checked_at timestamp",
        (LOAD,),
    ),
    CHANGES: Table(
        "pipeline_name string, column_name string, change_type string, status string, "
        "detected_at timestamp, approved_at timestamp, applied_at timestamp",
        (LOAD,),
    ),
    QUEUE: Table(
        "pipeline_name string, start_time timestamp, end_time timestamp, processed boolean, updated_at timestamp",
        (LOAD,),
    ),
    QUEUE_DONE: Table(
        "pipeline_name string, start_time timestamp, end_time timestamp, run_start timestamp, done_at timestamp"
    ),
    REPLAY_MARKS: Table(
        "event_hash string, quarantine_at timestamp, read_until timestamp, replayed_at timestamp, replay_batch_id string",
        ("p_hour",),
        "quarantine_at",
    ),
    RULES: Table("error_reason string, action_value string, enabled boolean, auto_replay boolean"),
    REPLAYS: Table(
        "replay_batch_id string, source_error_reason string, candidate_count bigint, "
        "repaired_count bigint, skipped_count bigint, created_at timestamp"
    ),
    METRICS: Table(
        "pipeline_name string, snapshot_id string, total_count bigint, valid_count bigint, bad_count bigint, "
        "bad_rate double, duplicate_removed_count bigint, duplicate_rate double, created_at timestamp"
    ),
    "gold.event_type_5min_count": Table(
        "event_type string, count bigint, window_start timestamp, window_end timestamp", ("p_hour",), "window_start"
    ),
    "gold.category_5min_count": Table(
        "category string, count bigint, window_start timestamp, window_end timestamp", ("p_hour",), "window_start"
    ),
    "gold.revenue_5min": Table(
        "revenue bigint, window_start timestamp, window_end timestamp", ("p_hour",), "window_start"
    ),
    "gold.active_user_5min": Table(
        "active_user_count bigint, window_start timestamp, window_end timestamp", ("p_hour",), "window_start"
    ),
    "gold.device_5min_summary": Table(
        f"start_time timestamp, end_time timestamp, device string, {SUMMARY}", ("p_hour",), "start_time"
    ),
    "gold.category_conversion_5min": Table(
        f"start_time timestamp, end_time timestamp, category string, {SUMMARY}", ("p_hour",), "start_time"
    ),
    "gold.user_activity_5min_summary": Table(
        "start_time timestamp, end_time timestamp, user_id string, view_count bigint, click_count bigint, "
        "add_to_cart_count bigint, purchase_count bigint, revenue double, last_active_time timestamp, "
        "updated_at timestamp",
        ("p_hour",),
        "start_time",
    ),
    USER_PROFILE: Table(
        "user_id string, total_view bigint, total_click bigint, total_add_to_cart bigint, total_purchase bigint, "
        "total_revenue double, favorite_category string, favorite_device string, last_active_time timestamp, "
        "updated_at timestamp",
        ("snapshot_id",),
    ),
    USER_HOURS: Table(USER_SUMS, ("p_hour", "snapshot_id")),
    USER_TOTALS: Table(USER_SUMS, ("snapshot_id",)),
}

# The four monitoring tables also exist keyed by (dt, hour) text, filled by the backfill job.
BACKFILL_DATASETS = ("event_type_5min_count", "category_5min_count", "revenue_5min", "active_user_5min")
for _name in BACKFILL_DATASETS:
    TABLES[f"gold_backfill.{_name}"] = Table(TABLES[f"gold.{_name}"].columns, ("dt", "hour"))

# Fixed coverage lists of the maintenance jobs.
EXPIRED_TABLES = (
    BRONZE,
    CLEAN_EVENTS,
    "gold.event_type_5min_count",
    "gold.category_5min_count",
    "gold.revenue_5min",
    "gold.active_user_5min",
)
COMPACTED_RAW_AND_CLEAN = (BRONZE, CLEAN_EVENTS)
COMPACTED_GOLD = tuple(f"gold.{name}" for name in BACKFILL_DATASETS)
