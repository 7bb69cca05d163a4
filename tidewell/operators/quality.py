"""Data-quality metrics and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# An alert needs a rate strictly above its threshold.
BAD_RATE_THRESHOLD = 0.05
DUPLICATE_RATE_THRESHOLD = 0.10


def data_quality_metrics(summaries: DataFrame) -> DataFrame:
    """Rates of the newest quality summary of any pipeline; 0 where nothing was counted."""

    def rate(part: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col("total_count")), F.lit(0.0))

    newest = summaries.orderBy(F.desc("created_at"), F.desc("snapshot_id")).limit(1)
    return newest.select(
        "pipeline_name",
        F.col("snapshot_id").cast("string").alias("snapshot_id"),
        "total_count",
        "valid_count",
        "bad_count",
        rate("bad_count").alias("bad_rate"),
        "duplicate_removed_count",
        rate("duplicate_removed_count").alias("duplicate_rate"),
    )


def quality_alerts(metrics: DataFrame) -> DataFrame:
    """A message per metrics row above a threshold; sending it is up to the caller."""

    def percent(rate: str) -> Column:
        return F.concat(F.format_number(F.col(rate) * 100, 2), F.lit("%"))

    over = (F.col("bad_rate") > BAD_RATE_THRESHOLD) | (F.col("duplicate_rate") > DUPLICATE_RATE_THRESHOLD)
    lines = (
        ("Pipeline: ", F.col("pipeline_name")),
        ("Snapshot: ", F.col("snapshot_id")),
        ("Total: ", F.col("total_count").cast("string")),
        ("Valid: ", F.col("valid_count").cast("string")),
        ("Bad: ", F.col("bad_count").cast("string")),
        ("Bad Rate: ", percent("bad_rate")),
        ("Duplicate Removed: ", F.col("duplicate_removed_count").cast("string")),
        ("Duplicate Rate: ", percent("duplicate_rate")),
    )
    message = F.concat_ws("\n", F.lit("Data Quality Alert"), *[F.concat(F.lit(label), value) for label, value in lines])
    return metrics.filter(over).select("pipeline_name", "snapshot_id", "bad_rate", "duplicate_rate", message.alias("message"))
