"""One registered query per operator, each over the whole ``events`` table of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import fixture
from tidewell import prepare
from tidewell.functions.events import hour_index, hour_start
from tidewell.operators import bronze as raw_layer
from tidewell.operators import drift, gold, maintenance, merge, profile, quality, ranges, replay, silver, snapshots
from tidewell.plans.backfill import BACKFILL, run_backfill
from tidewell.plans.gold import queue_state, run_gold
from tidewell.plans.maintenance import compact
from tidewell.plans.quality import run_quality
from tidewell.plans.replay import run_replay
from tidewell.plans.silver import GOLD, SILVER, run_silver
from tidewell.schemas import (
    BACKFILL_DATASETS,
    BAD_EVENTS,
    BRONZE,
    CHANGES,
    CLEAN_EVENTS,
    QUALITY,
    QUEUE,
    QUEUE_DONE,
    REPLAYS,
    RULES,
    STATE,
    USER_PROFILE,
)
from tidewell.sources.tables import Lake, new_root, read_incremental, side_by_side
from tidewell.sources.topic import file_source
from tidewell.streaming.ingest import start_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH = "replay_20240131000000"


def exposed(df: DataFrame) -> DataFrame:
    """Zone-free times and plain text for lists, so that any SQL engine's values compare."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return exposed(function(prepare(spark), sf_dir))

    QUERIES[function.__name__] = run
    return function


# --- inputs -------------------------------------------------------------------------------------


def bronze(spark: SparkSession, sf_dir: str, extra: str | None = None) -> DataFrame:
    return raw_layer.bronze_parse(fixture.topic(spark, sf_dir, extra))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.with_event_hash(silver.silver_project(bronze(spark, sf_dir)))


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_batch(bronze(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.split_valid(batch(spark, sf_dir)).drop("copies")


def bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows, stamped with their topic time so that results can be compared."""
    return silver.quarantine(batch(spark, sf_dir), now=F.col("kafka_timestamp"))


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.repair_events(replay.replay_candidates(bad(spark, sf_dir)), fixture.repair_rules(spark))


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.event_measures(clean(spark, sf_dir))


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.windowed(measures(spark, sf_dir))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_of(spark, clean(spark, sf_dir))


def queue_of(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Every hour with valid events, queued at the time of its last one; stored, as the queue is a table."""
    hour = hour_index("event_time").alias("hour")
    hours = rows.groupBy(hour).agg(F.max("kafka_timestamp").alias("updated_at"))
    rows = hours.select(
        F.lit(GOLD).alias("pipeline_name"),
        hour_start("hour").alias("start_time"),
        hour_start(F.col("hour") + 1).alias("end_time"),
        F.lit(False).alias("processed"),
        "updated_at",
    )
    return lake(spark, "queue").stage(rows, "queue")


def done(queued: DataFrame) -> DataFrame:
    """Runs that did the hours of the first half of every day, each begun 58 minutes into the hour."""
    began = F.col("start_time") + F.expr("INTERVAL 58 MINUTES")
    return queued.filter(F.hour("start_time") < 12).select(
        "pipeline_name",
        "start_time",
        "end_time",
        began.alias("run_start"),
        (began + F.expr("INTERVAL 1 HOUR")).alias("done_at"),
    )


def queue_after_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    queued = queue(spark, sf_dir)
    return ranges.mark_processed(queued, done(queued))


def lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, new_root(spark, purpose))


def load_snapshot(store: Lake, rows: DataFrame, snapshot_id: int) -> None:
    """Commit topic rows as one bronze snapshot, as the stream does per micro-batch."""
    store.write_snapshot(raw_layer.bronze_parse(rows).withColumn("snapshot_id", F.lit(snapshot_id)), BRONZE)
    store.commit(BRONZE, snapshot_id, "append")


def loaded(spark: SparkSession, sf_dir: str, purpose: str) -> Lake:
    """A store whose clean layer holds the whole topic."""
    store = lake(spark, purpose)
    load_snapshot(store, fixture.topic(spark, sf_dir), 1)
    store.append(fixture.repair_rules(spark), RULES)
    run_silver(store)
    return store


def twice_loaded(spark: SparkSession, sf_dir: str, purpose: str) -> Lake:
    """A store whose clean layer took the topic in two overlapping snapshots, one run each."""
    store, rows = lake(spark, purpose), fixture.two_snapshots(fixture.topic(spark, sf_dir))
    for snapshot_id in (1, 2):
        part = rows.filter(F.col("snapshot_id") == snapshot_id).drop("snapshot_id")
        load_snapshot(store, part, snapshot_id)
        run_silver(store)
    return store


# --- sources ------------------------------------------------------------------------------------


@query
def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir)


@query
def bronze_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = lake(spark, "stream")
    landing = f"{store.root}/landing"
    rows = fixture.topic(spark, sf_dir).drop("event_id", "copy_no")
    rows.repartition(3, "partition", "offset").write.parquet(landing)
    stream = start_bronze(file_source(spark, landing), store, f"{store.root}/checkpoint", {"availableNow": True})
    stream.awaitTermination()
    return store.read(BRONZE).drop("snapshot_id")


@query
def incremental_snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = lake(spark, "incremental")
    rows = fixture.two_snapshots(fixture.topic(spark, sf_dir))
    for snapshot_id in (1, 2):
        part = raw_layer.bronze_parse(rows.filter(F.col("snapshot_id") == snapshot_id))
        store.write_snapshot(part.withColumn("snapshot_id", F.lit(snapshot_id)), BRONZE)
    return read_incremental(store.read(BRONZE), 1, 2).drop("snapshot_id")


@query
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixture.snapshot_log(spark, sf_dir)
    return snapshots.latest_snapshot(log.filter(F.col("table_name") == BRONZE))


@query
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixture.snapshot_log(spark, sf_dir)
    name = F.when(F.col("table_name") == BRONZE, SILVER).otherwise(GOLD)
    runs = log.select(
        name.alias("pipeline_name"),
        F.col("snapshot_id").alias("last_snapshot_id"),
        F.col("committed_at").alias("updated_at"),
    )
    return snapshots.latest_state(runs, SILVER)


@query
def file_stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.file_stats_summary(fixture.file_listing(spark, sf_dir))


@query
def largest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintenance.largest_files(fixture.file_listing(spark, sf_dir))


@query
def gold_partition_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets by dt and hour, of which the queue asks for the first half of every day; all from one read of the topic."""
    store = lake(spark, "backfill")
    valid = store.stage(clean(spark, sf_dir), "clean")
    rows = gold.windowed(gold.event_measures(valid))
    source, tasks = f"{store.root}/datasets", spark.sparkContext.defaultParallelism
    by_hour = [
        F.date_format("window_start", "yyyy-MM-dd").alias("dt"),
        F.lpad(F.hour("window_start").cast("string"), 2, "0").alias("hour"),
    ]

    def lay_out(dataset: str) -> None:
        laid_out = gold.WINDOW_TABLES[dataset](rows).select("*", *by_hour).repartition(tasks, "dt", "hour")
        laid_out.write.partitionBy("dt", "hour").parquet(f"{source}/{dataset}")

    side_by_side(spark, lay_out, [(dataset,) for dataset in BACKFILL_DATASETS])
    wanted = queue_of(spark, valid).filter(F.hour("start_time") < 12)
    store.append(wanted.withColumn("pipeline_name", F.lit(BACKFILL)), QUEUE)
    run_backfill(store, source)
    values = {
        "event_type_5min_count": ("event_type", "count"),
        "category_5min_count": ("category", "count"),
        "revenue_5min": (None, "revenue"),
        "active_user_5min": (None, "active_user_count"),
    }
    return _stacked(
        (
            dataset,
            store.read(f"gold_backfill.{dataset}"),
            ["dt", "hour", "window_start", _text(name), F.col(value).cast("double").alias("value")],
        )
        for dataset, (name, value) in values.items()
    )


def _text(name: str | None):
    return (F.col(name) if name else F.lit(None).cast("string")).alias("name")


def _stacked(parts) -> DataFrame:
    stacked = None
    for dataset, df, columns in parts:
        part = df.select(F.lit(dataset).alias("dataset"), *columns)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


# --- table mutation -----------------------------------------------------------------------------


@query
def merge_insert_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events of two snapshots, stored as a batch is: an anti join on a stored hash is not pushed into the parsing."""
    store, rows = lake(spark, "merge"), fixture.two_snapshots(fixture.topic(spark, sf_dir))
    first, second = (
        store.stage(
            silver.split_valid(
                silver.silver_batch(raw_layer.bronze_parse(rows.filter(F.col("snapshot_id") == number)))
            ).drop("copies"),
            "batch",
        )
        for number in (1, 2)
    )
    return merge.merge_insert(first, second, ["event_hash"])


@query
def merge_insert_multikey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change requests of two batches: the first brings ``coupon``, the second both it and ``campaign``."""
    store, identity = lake(spark, "merge"), ["pipeline_name", "column_name", "change_type"]
    texts = (',"coupon":"x"', ',"coupon":"y","campaign":"z"')
    first, second = (
        drift.schema_change_requests(
            store.stage(drift.observed_keys(bronze(spark, sf_dir, text)), "keys"), SILVER
        ).withColumn("status", F.lit(status))
        for text, status in zip(texts, ("pending", "again"))
    )
    return merge.merge_insert(first, second, identity)


@query
def mark_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a first load are replayed, those of a second one, which repeats some events, are not."""
    store, rows = lake(spark, "replay"), fixture.two_snapshots(fixture.topic(spark, sf_dir))
    store.append(fixture.repair_rules(spark), RULES)
    for snapshot_id in (1, 2):
        load_snapshot(store, rows.filter(F.col("snapshot_id") == snapshot_id).drop("snapshot_id"), snapshot_id)
        run_silver(store)
        if snapshot_id == 1:
            run_replay(store, BATCH)
    return store.read(BAD_EVENTS).select(
        "event_hash", "is_replayed", "replay_batch_id", F.col("replayed_at").isNotNull().alias("has_time")
    )


@query
def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of snapshot 1, then the hours of snapshot 2 replaced by its own counts."""
    store, name = lake(spark, "overwrite"), "gold.event_type_5min_count"
    rows = fixture.two_snapshots(fixture.topic(spark, sf_dir))
    for number in (1, 2):
        part = silver.split_valid(silver.silver_batch(raw_layer.bronze_parse(rows.filter(F.col("snapshot_id") == number))))
        counts = gold.event_type_5min_count(gold.windowed(gold.event_measures(part)))
        store.overwrite_partitions(counts, name)
    return store.read(name).drop("p_hour")


@query
def mark_partitions_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_after_runs(spark, sf_dir)


# --- projections and filters --------------------------------------------------------------------


@query
def silver_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_project(bronze(spark, sf_dir))


@query
def event_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("user_id", "product_id", "kafka_timestamp", "event_hash")


@query
def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.validate(events(spark, sf_dir)).select("event_hash", "kafka_timestamp", "error_reasons")


@query
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir)


@query
def quarantine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bad(spark, sf_dir)


@query
def time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = (F.lit(text).cast("timestamp") for text in ("2024-01-05 06:30:00", "2024-01-20 18:00:00"))
    return ranges.time_range(clean(spark, sf_dir), start, end)


@query
def replay_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After one replay of the rows that lack a time, the others are still open."""
    rows = lake(spark, "candidates").stage(bad(spark, sf_dir), "bad")
    hashes = rows.filter(F.array_contains("error_reasons", "event_time_is_null")).select("event_hash")
    marked = replay.mark_replayed(rows, hashes, BATCH, now=F.col("kafka_timestamp"))
    return replay.replay_candidates(marked).select("event_hash", "is_replayed", "error_reasons")


@query
def pending_range_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = ranges.pending_ranges(queue_after_runs(spark, sf_dir), GOLD)
    return ranges.in_ranges(clean(spark, sf_dir), pending)


# --- aggregates ---------------------------------------------------------------------------------


def _window_query(dataset: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return gold.WINDOW_TABLES[dataset](windows(spark, sf_dir))

    run.__name__ = dataset
    query(run)


def _profile_query(function) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(measures(spark, sf_dir))

    run.__name__ = function.__name__
    query(run)


for _dataset in gold.WINDOW_TABLES:
    _window_query(_dataset)
for _function in (
    profile.user_metrics,
    profile.user_category_counts,
    profile.user_device_counts,
    profile.favorite_category,
    profile.favorite_device,
    profile.user_profile,
):
    _profile_query(_function)


@query
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quality_summary(batch(spark, sf_dir), SILVER, 1)


@query
def error_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.error_reason_counts(bad(spark, sf_dir))


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedup_events(events(spark, sf_dir))


# --- drift --------------------------------------------------------------------------------------

COUPON = ',"coupon":"x"'


@query
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_drift(drift.observed_keys(bronze(spark, sf_dir, COUPON)), SILVER)


@query
def schema_change_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over drifting snapshots leave one request per new key."""
    store = lake(spark, "drift")
    for snapshot_id, text in ((1, COUPON), (2, ',"coupon":"y","campaign":"z"')):
        load_snapshot(store, fixture.topic(spark, sf_dir, text), snapshot_id)
        run_silver(store)
    return store.read(CHANGES).drop("detected_at")


# --- jobs ---------------------------------------------------------------------------------------


@query
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twice_loaded(spark, sf_dir, "incremental").read(CLEAN_EVENTS).drop("p_hour")


@query
def incremental_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality summary of each run beside the state it left."""
    store = twice_loaded(spark, sf_dir, "incremental")
    state = store.read(STATE).select(F.col("last_snapshot_id").alias("snapshot_id"))
    return store.read(QUALITY).drop("created_at").join(state, "snapshot_id")


@query
def affected_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.affected_hours(clean(spark, sf_dir), GOLD)


@query
def pending_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.pending_ranges(queue_after_runs(spark, sf_dir), GOLD)


@query
def repair_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.dedup_events(repaired(spark, sf_dir).select(*silver.SILVER_COLUMNS))


@query
def replay_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded(spark, sf_dir, "replay")
    run_replay(store, BATCH)
    return store.read(CLEAN_EVENTS).drop("p_hour")


@query
def replay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = loaded(spark, sf_dir, "replay")
    run_replay(store, BATCH)
    return store.read(REPLAYS).drop("created_at")


@query
def gold_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight aggregate tables after load, replay and refresh."""
    store = loaded(spark, sf_dir, "gold")
    run_replay(store, BATCH)
    run_gold(store)
    none = F.lit(None).cast("timestamp").alias("start_time")
    counts = F.col("view_count") + F.col("click_count") + F.col("add_to_cart_count") + F.col("purchase_count")
    totals = F.col("total_view") + F.col("total_click") + F.col("total_add_to_cart") + F.col("total_purchase")
    start, number = F.col("window_start").alias("start_time"), F.lit(0.0).alias("amount")

    def value(column):
        return column.cast("bigint").alias("number")

    layouts = {
        "event_type_5min_count": [start, _text("event_type"), value(F.col("count")), number],
        "category_5min_count": [start, _text("category"), value(F.col("count")), number],
        "revenue_5min": [start, _text(None), value(F.col("revenue")), number],
        "active_user_5min": [start, _text(None), value(F.col("active_user_count")), number],
        "device_5min_summary": [
            "start_time",
            _text("device"),
            value(counts + F.col("active_user_count")),
            (F.col("ctr") + F.col("revenue")).alias("amount"),
        ],
        "category_conversion_5min": [
            "start_time",
            _text("category"),
            value(counts + F.col("active_user_count")),
            (F.col("purchase_conversion_rate") + F.col("revenue")).alias("amount"),
        ],
        "user_activity_5min_summary": [
            "start_time",
            _text("user_id"),
            value(counts),
            F.col("revenue").alias("amount"),
        ],
    }
    profiles = store.read(USER_PROFILE).withColumn(
        "name", F.concat_ws("/", "user_id", F.coalesce("favorite_category", F.lit("-")), "favorite_device")
    )
    parts = [(dataset, store.read(f"gold.{dataset}"), columns) for dataset, columns in layouts.items()]
    parts.append(
        ("user_profile", profiles, [none, "name", value(totals), F.col("total_revenue").alias("amount")])
    )
    return _stacked(parts)


@query
def late_data_recompute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event arrives a snapshot later; its hours are refreshed whole."""
    store, rows = lake(spark, "late"), fixture.topic(spark, sf_dir)
    late = F.col("event_id") % 7 == 0
    for snapshot_id, part in ((1, rows.filter(~late)), (2, rows.filter(late))):
        load_snapshot(store, part, snapshot_id)
        run_silver(store)
        run_gold(store)
    return store.read("gold.device_5min_summary").drop("p_hour", "updated_at")


# --- quality ------------------------------------------------------------------------------------


@query
def data_quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the later of two batches."""
    rows = fixture.two_snapshots(fixture.topic(spark, sf_dir))
    parts = (
        silver.quality_summary(
            silver.silver_batch(raw_layer.bronze_parse(rows.filter(F.col("snapshot_id") == number))), SILVER, number
        ).withColumn("created_at", F.lit(f"2024-02-0{number} 00:00:00").cast("timestamp"))
        for number in (1, 2)
    )
    first, second = parts
    return quality.data_quality_metrics(first.unionByName(second))


@query
def quality_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_quality(loaded(spark, sf_dir, "quality"))


# --- maintenance --------------------------------------------------------------------------------


@query
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of few events fit in fewer files than they have, others do not."""
    return maintenance.compaction_plan(fixture.file_listing(spark, sf_dir), target_bytes=2048)


@query
def compacted_rows_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = twice_loaded(spark, sf_dir, "compaction")
    compact(store, CLEAN_EVENTS)
    return store.read(CLEAN_EVENTS).drop("p_hour")


@query
def expired_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixture.snapshot_log(spark, sf_dir)
    return maintenance.expired_snapshots(log, F.lit("2024-01-31 00:00:00").cast("timestamp"))


@query
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per user and day of the events; those of expired snapshots are referenced no more."""
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    day = F.dayofyear("ts").cast("bigint")
    listing = (
        fixture.events(spark, sf_dir)
        .groupBy(day.alias("snapshot_id"), "user_id")
        .agg(F.max("ts").cast("timestamp").alias("modified_at"), F.count(F.lit(1)).alias("size"))
        .withColumn("path", F.concat_ws("/", F.lit("bronze"), "snapshot_id", "user_id"))
    )
    log = fixture.snapshot_log(spark, sf_dir).filter(F.col("table_name") == BRONZE)
    expired = maintenance.expired_snapshots(log, now)
    referenced = listing.join(expired, "snapshot_id", "left_anti")
    return maintenance.orphan_files(listing.drop("snapshot_id"), referenced, now)
