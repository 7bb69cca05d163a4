"""Table upkeep: file statistics, compaction plans, snapshot expiry, orphan files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TARGET_FILE_BYTES = 512 * 1024 * 1024
RETAIN_LAST = 3
MAX_SNAPSHOT_AGE_DAYS = 5
MAX_ORPHAN_AGE_DAYS = 3


def file_stats(table: DataFrame) -> DataFrame:
    """One row per data file. Row counts come from the footers: no column is read."""
    files = table.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes")
    )
    return files.groupBy("file_path", "file_size_in_bytes").agg(F.count(F.lit(1)).alias("record_count")).select(
        "file_path", "record_count", "file_size_in_bytes"
    )


def file_stats_summary(files: DataFrame) -> DataFrame:
    return files.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)).alias("total_bytes"),
    )


def largest_files(files: DataFrame, count: int = 20) -> DataFrame:
    """The top files by size: a report, so the limit is its meaning."""
    return files.orderBy(F.desc("file_size_in_bytes"), "file_path").limit(count)


def compaction_plan(files: DataFrame, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Per directory, how many files there are and how many of the target size would hold them."""
    directory = F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)
    sizes = files.groupBy(directory.alias("directory")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("file_size_in_bytes").alias("total_bytes")
    )
    needed = F.greatest(F.ceil(F.col("total_bytes") / target_bytes), F.lit(1)).cast("bigint")
    planned = sizes.withColumn("target_file_count", needed)
    return planned.withColumn("rewrite", F.col("file_count") > F.col("target_file_count"))


def partition_value(path: Column, name: str) -> Column:
    """The value of a partition directory in a file path; NULL for the null partition."""
    text = F.regexp_extract(path, f"/{name}=([^/]*)", 1)
    return F.when(~text.isin("", "__HIVE_DEFAULT_PARTITION__"), text)


def expired_snapshots(
    log: DataFrame, now: Column, retain_last: int = RETAIN_LAST, max_age_days: int = MAX_SNAPSHOT_AGE_DAYS
) -> DataFrame:
    """Snapshots older than the age limit that are not among the newest of their table.

    Only the newest few per table are ranked (the limit prunes before the shuffle), the rest is an anti join.
    """
    newest_first = Window.partitionBy("table_name").orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    kept = log.withColumn("rank", F.row_number().over(newest_first)).filter(F.col("rank") <= retain_last)
    old = log.filter(F.col("committed_at") < now - F.make_dt_interval(days=F.lit(max_age_days)))
    return old.join(kept.select("table_name", "snapshot_id"), ["table_name", "snapshot_id"], "left_anti").select(
        "table_name", "snapshot_id", "committed_at"
    )


def orphan_files(
    listing: DataFrame, referenced: DataFrame, now: Column, max_age_days: int = MAX_ORPHAN_AGE_DAYS
) -> DataFrame:
    """Listed files that nothing references and that are too old to belong to a running write."""
    old = listing.filter(F.col("modified_at") < now - F.make_dt_interval(days=F.lit(max_age_days)))
    return old.join(referenced.select("path"), "path", "left_anti").select("path", "modified_at", "size")
