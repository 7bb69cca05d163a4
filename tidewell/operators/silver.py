"""Clean layer: re-parse, hash, deduplicate, validate, split and count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewell.functions.events import HASH_NULL, error_reasons, event_hash
from tidewell.schemas import BAD_EVENTS, CLEAN_EVENTS, TABLES

PAYLOAD = (
    "user_id string, event_type string, product_id string, category string, "
    "price bigint, event_time string, device string"
)
SILVER_COLUMNS = TABLES[CLEAN_EVENTS].names


def silver_project(bronze: DataFrame) -> DataFrame:
    """Parse ``raw_value`` again with the wider payload; only it and the topic time are read."""
    payload = bronze.select("kafka_timestamp", F.from_json("raw_value", PAYLOAD).alias("payload"))
    return payload.select(
        "payload.user_id",
        "payload.event_type",
        "payload.product_id",
        "payload.category",
        "payload.price",
        F.try_to_timestamp("payload.event_time").alias("event_time"),
        "kafka_timestamp",
        "payload.device",
    )


def with_event_hash(events: DataFrame) -> DataFrame:
    return events.withColumn("event_hash", event_hash())


def dedup_events(events: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per content hash, the earliest by topic time (a NULL time is the latest); ``copies`` names a count of the copies.

    Rows are grouped by their content with buffers of fixed width, so both sides of the shuffle aggregate by hash and a
    record repeated any number of times sends one row per input task. Two contents can share a hash only if a text holds
    a bar, as the separator is two: only those rows are grouped once more. Where their times tie, the smallest row stays.
    """
    grouped, barred = _by_content(events), F.col("_found.barred")  # both branches read the same shuffle
    settled = _contents(events, grouped.filter(~barred)).unionByName(one_per_hash(_contents(events, grouped.filter(barred))))
    counted = settled.withColumnRenamed("_copies", copies) if copies else settled.drop("_copies")
    return counted.select(*events.columns, *([copies] if copies else []))


def distinct_contents(events: DataFrame) -> DataFrame:
    """One row per content with its earliest topic time, its hash, ``_copies`` and ``_barred`` (a text of it holds a bar)."""
    return _contents(events, _by_content(events))


def _texts(events: DataFrame) -> list[str]:
    return [field.name for field in events.schema if isinstance(field.dataType, T.StringType) and field.name != "event_hash"]


def _by_content(events: DataFrame) -> DataFrame:
    """Contents and what is ``_found`` of each.

    A NULL and the text that stands for it hash alike. They are grouped as one; a number made of the time and of which
    texts are meant literally tells at its minimum which of them the earliest row had.
    """
    rest = [name for name in events.columns if name not in ("event_hash", "kafka_timestamp")]
    texts = _texts(events)
    literal = [F.when(F.col(name) == HASH_NULL, 1 << place).otherwise(0) for place, name in enumerate(reversed(texts))]
    bits, width = sum(literal, F.lit(0)), 1 << len(texts)
    reach = F.lit((1 << 62) // width)
    micros = F.least(F.greatest(F.coalesce(F.unix_micros("kafka_timestamp"), reach), -reach), reach)
    barred = sum((F.coalesce(F.contains(name, F.lit("|")), F.lit(False)).cast("int") for name in texts), F.lit(0)) > 0
    keys = [F.coalesce(name, F.lit(HASH_NULL)).alias(name) if name in texts else F.col(name) for name in rest]
    found = F.struct(
        F.min("kafka_timestamp").alias("kafka_timestamp"),
        F.count(F.lit(1)).alias("copies"),
        F.min(micros * width + bits).alias("first"),
        F.max(barred).alias("barred"),
    )
    return events.groupBy(*keys).agg(found.alias("_found"))


def _contents(events: DataFrame, grouped: DataFrame) -> DataFrame:
    """The rows of grouped contents. Every value depends on what was found, so no later condition moves below the grouping.

    It would in one branch of :func:`dedup_events` only, and the branches would no longer share their shuffle.
    """
    texts = _texts(events)
    is_literal = {name: F.col("_found.first").bitwiseAND(1 << place) != 0 for place, name in enumerate(reversed(texts))}
    values = {name: F.when((F.col(name) != HASH_NULL) | is_literal[name], F.col(name)) for name in texts}
    plain = [name for name in grouped.columns if name not in (*texts, "_found")]
    values |= {name: F.when(F.col("_found.copies") > 0, F.col(name)) for name in plain}
    values |= {name: F.col(f"_found.{name.lstrip('_')}") for name in ("kafka_timestamp", "_copies", "_barred")}
    return with_event_hash(grouped.withColumns(values)).drop("_found")


def one_per_hash(contents: DataFrame) -> DataFrame:
    """The earliest of the contents that share a hash, with the copies of all; for few rows, as the contents of a hash are listed."""
    rest = [name for name in contents.columns if name not in ("event_hash", "kafka_timestamp", "_copies")]
    row = F.struct(F.col("kafka_timestamp").isNull(), "kafka_timestamp", *rest)
    found = contents.groupBy("event_hash").agg(
        F.array_min(F.collect_list(row)).alias("first"), F.sum("_copies").alias("_copies")
    )
    kept = {name: F.col(f"first.{name}") for name in ("kafka_timestamp", *rest)}
    return found.withColumns(kept).select(*contents.columns)


def validate(events: DataFrame) -> DataFrame:
    return events.withColumn("error_reasons", error_reasons())


def split_valid(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size("error_reasons") == 0).drop("error_reasons")


def quarantine(validated: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows that break a rule, with the columns that track their repair."""
    now = F.current_timestamp() if now is None else now
    nothing = F.lit(None)
    tracked = {
        "created_at": now,
        "quarantine_at": now,
        "is_replayed": F.lit(False),
        "replayed_at": nothing.cast("timestamp"),
        "replay_batch_id": nothing.cast("string"),
    }
    return validated.filter(F.size("error_reasons") > 0).withColumns(tracked).select(*TABLES[BAD_EVENTS].names)


def silver_batch(bronze: DataFrame) -> DataFrame:
    """Bronze rows to distinct validated events; ``copies`` is how often each one came."""
    return validate(dedup_events(with_event_hash(silver_project(bronze)), copies="copies"))


def quality_summary(batch: DataFrame, pipeline: str, snapshot_id: int) -> DataFrame:
    """Total, valid, bad and repeated records of a batch from :func:`silver_batch`, in one row.

    The copy counts came with the deduplication, so the raw rows are not read again.
    """
    is_bad = F.size("error_reasons") > 0
    total = F.coalesce(F.sum("copies"), F.lit(0).cast("bigint"))
    return batch.agg(
        total.alias("total_count"),
        F.count_if(~is_bad).alias("valid_count"),
        F.count_if(is_bad).alias("bad_count"),
        (total - F.count(F.lit(1))).alias("duplicate_removed_count"),
    ).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(snapshot_id).cast("bigint").alias("snapshot_id"),
        "total_count",
        "valid_count",
        "bad_count",
        "duplicate_removed_count",
    )
