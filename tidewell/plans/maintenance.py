"""Maintenance jobs: compaction, snapshot expiry, removal of orphan files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.maintenance import (
    TARGET_FILE_BYTES,
    compaction_plan,
    expired_snapshots,
    file_stats,
    file_stats_summary,
    largest_files,
    orphan_files,
    partition_value,
)
from tidewell.operators.ranges import broadcast_if_small
from tidewell.schemas import BRONZE, COMPACTED_GOLD, COMPACTED_RAW_AND_CLEAN, EXPIRED_TABLES, SNAPSHOTS, TABLES, USER_PROFILE
from tidewell.sources.tables import Lake

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint"


def table_files(lake: Lake, name: str) -> DataFrame:
    return file_stats(lake.read(name))


def listed_files(lake: Lake, name: str) -> DataFrame:
    """Path, URI and size of a table's files, from the listing; of bronze, those of committed snapshots."""
    files = parquet_files(lake, name.replace(".", "/")).select(
        F.col("path").alias("file_path"), F.col("_metadata.file_path").alias("uri"), F.col("length").alias("file_size_in_bytes")
    )
    if name != BRONZE:
        return files
    snapshot = partition_value(F.col("file_path"), "snapshot_id").cast("bigint")
    committed = lake.commits(BRONZE).select("snapshot_id").distinct()
    return files.withColumn("snapshot_id", snapshot).join(committed, "snapshot_id", "left_semi").drop("snapshot_id")


def compact(lake: Lake, name: str, target_bytes: int = TARGET_FILE_BYTES) -> bool:
    """Merge the small files of the partitions that have more files than their bytes need.

    The plan and the rows come from one listing: exactly the listed files are read, merged beside the
    table, and then exchanged for the merged ones, directory by directory. Files that enter meanwhile are neither
    read nor removed. Rows know their file by its URI, which differs from the path where the path has a blank or a percent
    sign. Unless as many rows were merged as the files hold, nothing is exchanged. No snapshot is logged, as rows do not change; a second run finds nothing to do.
    Each partition is dealt to its number of files by a hash of the row, so a retried task writes the same rows.
    """
    keys = TABLES[name].partitions
    directory = F.regexp_extract("file_path", "^(.*)/[^/]*$", 1).alias("directory")
    listing = lake.stage(listed_files(lake, name).select("file_path", "uri", "file_size_in_bytes", directory), "listing")
    plan = compaction_plan(listing, target_bytes).filter("rewrite").select("directory", "target_file_count")
    todo = lake.stage(plan.join(listing, "directory").select("directory", "file_path", "uri", "target_file_count"), "compaction")
    old = [row.file_path for row in todo.select("file_path").toLocalIterator()]  # paths, not rows
    if not old:
        return False
    files = todo.select("directory", "target_file_count").distinct().agg(F.sum("target_file_count")).first()[0]
    counts = todo.select(F.col("uri").alias("read_path"), "target_file_count")
    read = lake.spark.read.schema(TABLES[name].full_schema).option("basePath", lake.path(name)).parquet(*old)
    paths = read.withColumn("read_path", F.col("_metadata.file_path"))
    rows = paths.join(broadcast_if_small(counts), "read_path").drop("read_path")
    share = F.pmod(F.xxhash64(*read.columns), F.col("target_file_count")).alias("share")
    dealt = rows.select(*read.columns, share).repartition(files, *keys, "share").drop("share")
    merged = f"{lake.root}/staging/merged-{uuid.uuid4().hex}"
    dealt.write.partitionBy(*keys).parquet(merged)
    held, written = read.count(), lake.spark.read.schema(TABLES[name].full_schema).parquet(merged).count()
    if held != written:
        raise RuntimeError(f"compaction of {name} merged {written} of {held} rows; no file was exchanged")
    _exchange(lake, name, old, merged)
    return True


def _exchange(lake: Lake, name: str, old: list[str], merged: str) -> None:
    """Move the merged files to their places and then remove the files that were read, directory by directory.

    A driver that dies between leaves a directory's rows twice, never lost.
    """
    jvm, configuration = lake.spark._jvm, lake.spark._jsc.hadoopConfiguration()
    target, source = jvm.org.apache.hadoop.fs.Path(lake.path(name)), jvm.org.apache.hadoop.fs.Path(merged)
    store = target.getFileSystem(configuration)
    former: dict[str, list[str]] = {}
    for path in old:
        former.setdefault(path.rpartition("/")[0].rpartition(name.replace(".", "/"))[2], []).append(path)
    new: dict[str, list[str]] = {}
    found = store.listFiles(source, True)
    while found.hasNext():
        path = found.next().getPath().toString()
        if path.endswith(".parquet"):
            new.setdefault(path.rpartition("/")[0].rpartition(merged.rpartition("/")[2])[2], []).append(path)
    if set(new) != set(former):
        raise RuntimeError(f"merged files of {name} are not of the directories that were read")
    for place, paths in former.items():
        for path in new[place]:
            to = f"{lake.path(name)}{place}/{path.rpartition('/')[2]}"
            if not store.rename(jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)):
                raise RuntimeError(f"{path} could not be moved to {to}; the files it replaces stay")
        for path in paths:
            store.delete(jvm.org.apache.hadoop.fs.Path(path), False)
    store.delete(source, True)


def compact_all(lake: Lake, names: tuple[str, ...]) -> DataFrame:
    """Compact several tables; files and bytes of each before and after."""
    totals = [F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("file_size_in_bytes"), F.lit(0)).alias("bytes")]
    figures = []
    for name in names:
        before = listed_files(lake, name).agg(*totals).first()
        compact(lake, name)
        after = listed_files(lake, name).agg(*totals).first()
        figures.append((name, *before, *after))
    schema = "table_name string, files_before bigint, bytes_before bigint, files_after bigint, bytes_after bigint"
    return lake.spark.createDataFrame(figures, schema)


def compact_raw_and_clean(lake: Lake) -> DataFrame:
    return compact_all(lake, COMPACTED_RAW_AND_CLEAN)


def compact_gold(lake: Lake) -> DataFrame:
    return compact_all(lake, COMPACTED_GOLD)


def compaction_report(lake: Lake, name: str) -> tuple[DataFrame, DataFrame]:
    """Totals and the largest files of a table."""
    files = table_files(lake, name)
    return file_stats_summary(files), largest_files(files)


def expire_snapshots(lake: Lake, now: Column | None = None) -> DataFrame:
    """Take expired snapshots off the log, by a mark that is appended; returns them.

    Besides the maintained tables this covers the profile, whose replaced versions would pile up.
    """
    now = F.current_timestamp() if now is None else now
    tables = [*EXPIRED_TABLES, USER_PROFILE]
    live = live_snapshots(lake).filter(F.col("table_name").isin(*tables))
    expired = lake.stage(expired_snapshots(live, now), "expired")
    marks = expired.select(
        "table_name",
        "snapshot_id",
        F.current_timestamp().alias("committed_at"),
        F.lit("expire").alias("operation"),
        F.lit(None).cast("string").alias("source_id"),
        F.lit(None).cast("bigint").alias("batch_id"),
    )
    lake.append(marks, SNAPSHOTS)
    return expired


def live_snapshots(lake: Lake) -> DataFrame:
    log = lake.read(SNAPSHOTS)
    marks = log.filter(F.col("operation") == "expire").select("table_name", "snapshot_id")
    return log.filter(F.col("operation") != "expire").join(marks, ["table_name", "snapshot_id"], "left_anti")


def parquet_files(lake: Lake, relative: str) -> DataFrame:
    return (
        lake.spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(f"{lake.root}/{relative}")
    )


def list_files(lake: Lake, relative: str) -> DataFrame:
    """Every parquet file below a folder, from the listing alone."""
    listed = parquet_files(lake, relative)
    return listed.select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("size"))


def unreferenced_files(lake: Lake, name: str, now: Column | None = None) -> DataFrame:
    """Old files of a versioned table whose snapshot was never committed, or was replaced and expired.

    Rows of an appended snapshot stay when the snapshot expires, as they are part of all later ones.
    """
    if "snapshot_id" not in TABLES[name].partitions:
        raise ValueError(f"{name} keeps no versions: all its files are referenced")
    now = F.current_timestamp() if now is None else now
    listing = list_files(lake, name.replace(".", "/"))
    kept = lake.commits(name).filter(F.col("operation") != "replace").unionByName(
        live_snapshots(lake).filter((F.col("table_name") == name) & (F.col("operation") == "replace"))
    )
    numbered = listing.withColumn("snapshot_id", partition_value(F.col("path"), "snapshot_id").cast("bigint"))
    referenced = numbered.join(broadcast_if_small(kept.select("snapshot_id").distinct()), "snapshot_id", "left_semi")
    return orphan_files(listing, referenced, now)


def stale_staging(lake: Lake, now: Column | None = None) -> DataFrame:
    """Files left in the staging folder by runs that are long over; nothing refers to them."""
    now = F.current_timestamp() if now is None else now
    listing = list_files(lake, "staging")
    return orphan_files(listing, listing.limit(0), now)


def delete_files(lake: Lake, files: DataFrame) -> int:
    """Delete listed files through the table's file system; paths stream by, partition after partition."""
    jvm, deleted = lake.spark._jvm, 0
    configuration = lake.spark._jsc.hadoopConfiguration()
    for row in files.select("path").toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(row["path"])
        deleted += bool(path.getFileSystem(configuration).delete(path, False))
    return deleted
